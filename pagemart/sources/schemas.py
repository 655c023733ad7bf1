"""Schemas of the inputs and of the JSON bodies, as Spark DDL."""

CAPTURED_PAGES = (
    "page_id bigint, url string, status int, body string, fetched_at timestamp, kind string, "
    "category_url string, category_name string, page_no int"
)
FETCH_LOG = (
    "request_id bigint, url string, proxy string, ts timestamp, status int, body_len int, exception string"
)
PAGE_EDGES = (
    "from_page bigint, to_url string, kind string, position int, category_url string, category_name string, "
    "parent_id string, goods_count string"
)

PRODUCT_LISTING = (
    "data struct<products: array<struct<id: bigint, name: string, brand: string, feedbackCount: int, "
    "salePrice: decimal(12,2)>>>"
)
WIDGETS = "widgetStates map<string,string>, nextPage string"
WIDGET_ITEMS = (
    "items array<struct<link: string, images: array<string>, cellTrackingInfo: struct<id: string, "
    "title: string, brandId: string, brand: string, category: string, marketplaceSellerId: string, "
    "deliverySchema: string, finalPrice: string>>>"
)
LD_PRODUCT = "`@type` string, name string, sku string, offers struct<Price: string>"
STATE_V1 = "data struct<nomenclatures: map<string, struct<ordersCount: int>>>"
STATE_V2 = (
    "router struct<ssrModel: struct<selectedNomenclature: struct<ordersCount: int>, "
    "product: struct<imtId: bigint, feedbacks: int>>>"
)
REVIEW_BATCH = "feedbacks array<struct<text: string, productValuation: int, createdDate: string>>"
