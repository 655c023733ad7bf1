"""Fixed values. They must equal what the shops use, or results differ."""

# Shop names written into the ``marketplace`` column.
WB = "wildberries"
OZON = "ozon"
TOYS = "igrushki-optom"
PRODUCTCENTER = "productcenter"

# Addresses records and follow-up pages are built from.
WB_HOST = "www.wildberries.ru"
WB_LISTING_API = "https://wbxcatalog-ru.wildberries.ru/nm-2-card/catalog?"
OZON_PAGE_API = "https://www.ozon.ru/api/composer-api.bx/page/json/v2?url="
OZON_FIRST_PAGE = "?layout_container=categorySearchMegapagination&layout_page_index=1&page=1"
OZON_WIDGET_KEY = "searchResultsV2"

# Words the cleaners and lookups match.
REVIEW_WORDS = "отзыв(а|ов)?"
BRAND_COUNTRY = "Страна бренда"
MAKER_COUNTRY = "Страна производитель"
ARTICLE_LABEL = "Артикул"
ALL_LABEL = "Все"
NO_BREAK_SPACE = "\u00a0"
ROUBLE = "\u20bd"

# Menu column classes that are not categories.
BANNER_MENU = "i-topmenus-banners"
SKIPPED_COLUMNS = ["menu-banner", "list-letters", "specbrands"]
FLAT_COLUMN = "categories"
TITLED_COLUMN = "category"

# Ban rules, retry and back-off settings.
NOT_BAN_STATUSES = [200, 301, 302]
IGNORED_EXCEPTION = "IgnoreRequest"
MAX_RETRIES = 5
BACKOFF_BASE = 300
BACKOFF_CAP = 3600
STATS_INTERVAL = "30 seconds"
REVIEW_BATCH = 1000

# Reasons a run ends for.
NONE_LEFT = "no_proxies"
NONE_AFTER_RESET = "no_proxies_after_reset"
