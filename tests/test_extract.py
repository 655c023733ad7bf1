"""Extraction jobs on small hand-made pages, each with a page that misses fields."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pagemart.functions import geo
from pagemart.plans import catalog, menu, positions, producers, reviews, shops
from pagemart.sources import readers, schemas, sinks

AT = dt.datetime(2024, 5, 1, 12)


def captured(spark, *pages):
    rows = []
    for i, page in enumerate(pages, 1):
        given = {"page_id": i, "url": "https://s.example/p", "status": 200, "body": "", "fetched_at": AT, "kind": "product",
                 "category_url": None, "category_name": None, "page_no": 1, **page}
        rows.append(tuple(given[c.split()[0]] for c in schemas.CAPTURED_PAGES.split(", ")))
    return spark.createDataFrame(rows, schemas.CAPTURED_PAGES)


CARD = """<div class="dt j-card-item"><a class="ref_goods_n_p" href="/catalog/{id}/detail.aspx?x=1">
<strong class="brand-name"> Brand </strong><span class="goods-name">Name {id}</span></a>
<ins class="lower-price">1&nbsp;234&nbsp;₽</ins><span class="dtList-comments-count">3 отзыва</span></div>"""


def test_listing_html(spark):
    body = f"""<h1>Cat</h1><div class="catalog-content">{CARD.format(id=5)}
    <div class="j-card-item"><a class="ref_goods_n_p" href="/brands/x"></a></div></div><div class="j-card-item">outside</div>"""
    pages = captured(spark, {"url": "https://www.wildberries.ru/catalog/a?page=1", "body": body}, {"body": "<p>no cards"})
    found = catalog.wb_listing_html(pages).orderBy("position").collect()
    assert [(r.wb_id, r.product_name, r.wb_reviews_count, r.wb_price, r.wb_brand_name, r.position) for r in found] == [
        (5, "Name 5", 3, Decimal("1234.00"), "Brand", 1), (None, None, None, None, None, 2),
    ]
    assert found[0].product_url == "https://www.wildberries.ru/catalog/5/detail.aspx"
    assert (found[0].wb_category_url, found[0].wb_category_name) == ("https://www.wildberries.ru/catalog/a", "Cat")
    assert [r.page_id for r in catalog.rejected(pages, catalog.wb_listing_html(pages)).collect()] == [2]


def test_listing_json(spark):
    body = '{"data":{"products":[{"id":1,"name":" n ","brand":"b","feedbackCount":2,"salePrice":10.5},{"id":2}]}}'
    pages = captured(
        spark, {"url": "http://api.example/x", "body": body, "category_url": "c", "category_name": "C"},
        {"body": "not json"}, {"body": '{"data":{"products":null}}'}, {"body": None},
    )
    found = catalog.wb_listing_json(pages).orderBy("position").collect()
    assert [(r.wb_id, r.product_name, r.wb_reviews_count, r.wb_price, r.position) for r in found] == [
        (1, "n", 2, Decimal("10.50"), 1), (2, None, None, None, 2),
    ]
    assert found[0].product_url == "http://www.wildberries.ru/catalog/1/detail.aspx"
    assert catalog.rejected(pages, catalog.wb_listing_json(pages)).count() == 3


def test_positions_have_no_gaps_and_differ_by_method(spark):
    sizes = {"hot": [3, 5, 2, 4], "b": [2, 2]}
    rows = [(f"{c}{p}", c, p, i) for c, ns in sizes.items() for p, n in enumerate(ns, 1) for i in range(1, n + 1)]
    cards = spark.createDataFrame(rows, "pid string, wb_category_url string, page_no int, position int").select(
        F.crc32("pid").alias("page_id"), "wb_category_url", "page_no", "position"
    )
    found = positions.running(cards).collect()
    for category, ns in sizes.items():
        got = sorted(r.wb_category_position for r in found if r.wb_category_url == category)
        assert got == list(range(1, sum(ns) + 1))
    by_offset = {(r.wb_category_url, r.page_no, r.position): r.wb_category_position for r in positions.by_offset(cards).collect()}
    assert by_offset["hot", 2, 1] == 4 and by_offset["hot", 3, 2] == 8 and by_offset["hot", 2, 5] == 8


PRODUCT = """<head><link rel="canonical" href="https://s.example/catalog/7/detail.aspx"></head>
<div class="brand-and-name"><span class="brand"> B </span><span class="name"><b>x</b> Name&nbsp;</span></div>
<div class="article">id <span> 7 </span></div><div class="brand-logo"><a href="/b"><img src=" /logo.png "></a></div>
<span class="final-cost"> 99&nbsp;₽ </span><div class="product-rating"><span>4.5</span></div><a class="count-review"><i>1 отзыв</i></a>
<div class="params"><div class="pp"><span><b>Страна бренда</b></span><span>A</span></div>
<div class="pp"><span><b>Страна бренда </b></span><span> B </span></div><div class="pp"><span><b>Нет</b></span></div></div>
<div class="pv-carousel"><div class="swiper-slide"><img src=" //i/tm/1.jpg"></div><div class="swiper-slide"><img></div></div>
<div class="options"><ul><li><a href="/catalog/8/detail.aspx?t=1">8</a></ul></div>
<div id="Comments"><a class="show-more" data-link="77">m</a></div>
<script>wb.spa.init({router: {ssrModel: {selectedNomenclature: {ordersCount: 11}, product: {imtId: 70, feedbacks: 2001}}}});</script>"""


def test_product_page(spark):
    url = "https://s.example/catalog/7/detail.aspx"
    pages = captured(
        spark, {"url": url, "body": PRODUCT}, {"url": url + "?old=1", "body": PRODUCT}, {"url": "https://s.example/x", "body": "<p>bare"},
    )
    found = {r.page_id: r for r in catalog.wb_product_page(pages, keep=("kind",)).collect()}
    assert set(found) == {1, 3}
    full = found[1]
    assert (full.product_name, full.wb_brand_name, full.wb_id, full.wb_price, full.wb_rating) == ("Name", "B", 7, Decimal("99.00"), 4.5)
    assert (full.wb_reviews_count, full.wb_purchases_count, full.wb_brand_logo, full.wb_brand_url) == (1, 11, "/logo.png", "/b")
    assert full.features == {"Страна бренда": "B", "Нет": None}
    assert (full.wb_brand_country, full.wb_manufacture_country) == ("B", None)
    assert full.image_urls == ["//i/big/1.jpg"]
    assert full.variant_urls == ["https://s.example/catalog/8/detail.aspx"]
    assert full.reviews_url == "https://s.example/catalog/7/otzyvy?field=Date&order=Asc&link=77"
    bare = found[3]
    assert (bare.product_name, bare.wb_id, bare.features, bare.image_urls, bare.wb_purchases_count) == (None, None, {}, [], None)
    assert "image_urls" not in catalog.wb_product_page(pages, skip_images=True).columns


def test_full_feed_joins_context_parents_and_reviews(spark):
    def page(key, kind):
        return {"url": f"https://s.example/catalog/{key}/detail.aspx", "kind": kind, "body": PRODUCT.replace("/catalog/7/", f"/catalog/{key}/").replace(" 7 ", f" {key} ")}

    pages = captured(spark, page(7, "product"), page(8, "variant"), page(9, "product"))
    edges = spark.createDataFrame(
        [("https://s.example/catalog/7/detail.aspx", 1, 4, "c1", "C1"), ("https://s.example/catalog/7/detail.aspx", 2, 9, "c2", "C2")],
        "to_url string, from_page bigint, position int, category_url string, category_name string",
    )
    dates = spark.createDataFrame(
        [("https://s.example/catalog/7/detail.aspx", AT), ("https://s.example/catalog/7/detail.aspx", AT + dt.timedelta(days=3))],
        "product_url string, created_at timestamp",
    )
    found = {r.wb_id: r for r in catalog.wb_products(pages, edges, dates).collect()}
    assert {k: r.wb_parent_id for k, r in found.items()} == {7: None, 8: 7, 9: None}
    assert (found[7].wb_category_url, found[7].wb_category_position) == ("c1", 4) and found[8].wb_category_url is None
    assert found[7].wb_first_review_date == AT and found[7].wb_last_review_date == AT + dt.timedelta(days=3)
    assert found[9].wb_first_review_date is None
    assert {r.wb_id for r in catalog.wb_products(pages, edges, dates, skip_variants=True).collect()} == {7, 9}


def test_route_and_json_listing_pages(spark):
    head = '<h1>C</h1><div id="catalog" data-xcatalog-path="p" data-xcatalog-query="q=1" data-xcatalog-total="{}">'
    cards = '<i class="j-card-item"></i>' * 10
    pages = captured(
        spark, {"url": "https://s.example/c?x", "body": head.format(25) + cards}, {"body": head.format(25)},
        {"body": head.format(0) + cards}, {"body": cards}, {"body": None},
    )
    by_json, by_html = catalog.route(pages)
    assert [r.page_id for r in by_json.orderBy("page_id").collect()] == [1, 2, 3]
    assert [r.page_id for r in by_html.orderBy("page_id").collect()] == [4, 5]
    edges = catalog.listing_edges(pages).orderBy("page").collect()
    assert [(r.from_page, r.page, r.offset, r.category_url) for r in edges] == [(1, p, (p - 1) * 10, "https://s.example/c") for p in (1, 2, 3)]
    assert edges[0].to_url == "https://wbxcatalog-ru.wildberries.ru/nm-2-card/catalog?q=1&page=1"


def test_ozon(spark):
    body = r'{"widgetStates":{"menu":"{}","searchResultsV2-1":"{\"items\":[{\"link\":\"/l\",\"images\":[\"i\"],\"cellTrackingInfo\":{\"id\":7,\"title\":\" t \",\"finalPrice\":15}}]}"},"nextPage":"/c/?page=2"}'
    pages = captured(spark, {"body": body}, {"body": '{"widgetStates":{"menu":"x"},"nextPage":"/c/?page=3"}'}, {"body": body.replace(',"nextPage":"/c/?page=2"', "")})
    found = catalog.ozon_listing(pages).orderBy("page_id").collect()
    assert [(r.page_id, r.ozon_id, r.product_name, r.ozon_price, r.position) for r in found] == [
        (1, "7", "t", Decimal("15.00"), 1), (3, "7", "t", Decimal("15.00"), 1),
    ]
    assert len(catalog.ozon_listing(pages).drop("page_id", "page_no", "position").columns) == 19
    assert [r.from_page for r in catalog.ozon_next_pages(pages).collect()] == [1]


def test_ozon_product_page(spark):
    body = '<script type="application/ld+json">{"@type":"Product","name":" n ","sku":"9","offers":{"Price":"1&nbsp;"}}</script><div class="product-rating-simple" title="4.9">'
    pages = captured(spark, {"body": body.replace("&nbsp;", " ")}, {"body": "<p>"})
    found = catalog.ozon_product_page(pages).collect()
    assert [(r.page_id, r.product_name, r.ozon_id, r.ozon_price, r.ozon_rating) for r in found] == [(1, "n", "9", Decimal("1.00"), 4.9)]


def test_brands_and_menu_links(spark):
    first = captured(spark, {"url": "https://w.example/list?letter=a", "body": '<div class="i-brand-list"><a href="/b/x?1"><span>X</span><img src="i"></a><a href="b/y">no span</a></div>'})
    assert [(r.wb_brand_name, r.wb_brand_url, r.wb_image_url) for r in catalog.wb_brands(first).collect()] == [
        ("X", "https://w.example/b/x", "i"), (None, "https://w.example/b/y", None),
    ]
    index = captured(spark, {"body": '<div class="b5y7"><a href="/all">Все</a><a href="/a">A</a><a href="/n"><img></a></div><div class="b5x9"><a href="/brand/q"> Q</a></div>'})
    assert [r.href for r in catalog.letter_links(index, ".b5y7").collect()] == ["/a", "/n"]
    assert [(r.ozon_brand_name, r.ozon_brand_url) for r in catalog.ozon_brands(index).collect()] == [("Q", "https://s.example/brand/q")]
    assert [(r.wb_category_name, r.wb_category_url) for r in catalog.menu_categories(index).collect()] == [
        ("Все", "/all"), ("A", "/a"), (None, "/n"), (" Q", "/brand/q"),
    ]


MENU = """<div id='top-menu'><ul><li data-menu-id='1'><a href='/t1'>T1</a></li><li data-menu-id='2'><a href='/t2'>T2</a></li></ul></div>
<div id="submenu"><ul data-menu-id='1'>
<li class='col category'><a href='/a'>A</a><ul><li><a href='/a1'>A1</a></li><li><a href='/a2'>A2</a></li></ul></li>
<li class='col category'><ul><li><a href='/a3'>A3</a></li></ul></li>
<li class='menu-banner'><a href='/ban'>ban</a></li>
<li class='col category'><ul><li><a href='/r'>after reset</a></li></ul></li>
<li class='col categories'><a href='/f1'>F1</a><a href='/f2'>F2</a></li></ul>
<ul data-menu-id='2'><li class='col category'><ul><li><a href='/b1'>B1</a></li></ul></li>
<li class='col category list-letters'><a href='/l'>L</a></li><li class='col category specbrands'><a href='/s'>S</a></li></ul>
<ul data-menu-id='9'><li class='col category'><a href='/u'>U</a></li></ul>
<ul class='x i-topmenus-banners' data-menu-id='1'><li class='category'><a href='/z'>Z</a></li></ul></div>"""


def test_category_tree(spark, tmp_path):
    rows = menu.category_rows(captured(spark, {"body": MENU}, {"body": "<p>"}))
    one, two, three = (sorted(map(tuple, t.collect())) for t in menu.category_tree(rows))
    assert one == [("T1", "/t1"), ("T2", "/t2")]
    assert two == [("T1", "A", "/a")]
    assert three == [
        ("T1", "", "F1", "/f1"), ("T1", "", "F2", "/f2"), ("T1", "", "after reset", "/r"), ("T1", "A", "A1", "/a1"),
        ("T1", "A", "A2", "/a2"), ("T1", "A", "A3", "/a3"), ("T2", "", "B1", "/b1"),
    ]
    assert {r.link for r in rows.where("NOT known").collect()} == {"/u", None}
    assert {(r.wb_category_name, r.wb_category_level) for r in menu.category_records(rows).collect()} >= {("T2", 1), ("A", 2), ("B1", 3)}
    sinks.write_csv(menu.category_tree(rows)[0], str(tmp_path / "l1"))
    lines = {line for f in (tmp_path / "l1").glob("*.csv") for line in f.read_text().splitlines()}
    assert lines == {"level_1;link", "T1;/t1", "T2;/t2"}


def test_producers(spark):
    cards = captured(
        spark, {"url": "https://p.example/producers/c-1?page-2", "body": '<h1>C</h1><div id="content"><div class="items"><div class="item"><a class="link" href="/producers/5/m">n</a>'
        '<a title="Все товары производителя">12</a></div><div class="item"><a class="link" href="https://q.example/6">n</a></div></div></div>'},
    )
    edges = producers.producer_cards(cards).orderBy("position").collect()
    assert [(r.to_url, r.category_url, r.category_name, r.goods_count) for r in edges] == [
        ("https://p.example/producers/5/m", "https://p.example/producers/c-1", "C", "12"),
        ("https://q.example/6", "https://p.example/producers/c-1", "C", None),
    ]
    page = """<link rel="canonical" href="https://p.example/producers/5/m"><h1 class="cfix">N</h1><div id="box_description"><div class="box_text"><b>about</b></div></div>
    <span itemprop="addressRegion">R</span><span itemprop="streetAddress">S</span><span itemprop="telephone">+7</span><a id="producer_link">site</a>
    <a class="fancybox" data-fancybox-group="producer" href="/l.png?1">x</a><div id="box_files"><a href="/a.xls?1">a</a></div>
    <script>coordinates: [59.939095, 30.315868]</script>"""
    pages = captured(spark, {"url": "https://p.example/producers/5/m", "body": page}, {"url": "https://p.example/z", "body": "<p>"})
    found = {r.page_id: r for r in producers.producers(pages, producers.producer_cards(cards), (55.751999, 37.617734)).collect()}
    r = found[1]
    assert (r.producer_name, r.producer_about, r.producer_address) == ("N", '<div class="box_text"><b>about</b></div>', "R S")
    assert (r.producer_logo, r.producer_price_lists, r.producer_goods_count) == ("https://p.example/l.png", ["https://p.example/a.xls"], "12")
    assert r.producer_distance == pytest.approx(634.6, abs=2)
    assert (found[2].producer_name, found[2].producer_coords, found[2].producer_distance) == (None, None, None)
    front = captured(spark, {"url": "https://p.example/", "body": "<div class='hcm_producers'><ul><li><ul><li><a href='/producers/c-1?x'>C1</a></li></ul></li></ul></div>"})
    assert [(r.to_url, r.category_name) for r in producers.menu_edges(front, "r-9").collect()] == [("https://p.example/producers/r-9/c-1", "C1")]


def vincenty(lat1, lon1, lat2, lon2):
    """The textbook iteration, to convergence."""
    a, b, f = geo.MAJOR_KM, geo.MINOR_KM, geo.FLATTENING
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    gap = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        ss = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if ss == 0:
            return 0.0
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma, sa = math.atan2(ss, cs), math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        c2 = 1 - sa * sa
        mid = cs - 2 * math.sin(u1) * math.sin(u2) / c2 if c2 else 0.0
        c = f / 16 * c2 * (4 + f * (4 - 3 * c2))
        new = gap + (1 - c) * f * sa * (sigma + c * ss * (mid + c * cs * (2 * mid * mid - 1)))
        if abs(new - lam) < 1e-12:
            break
        lam = new
    q = c2 * (a * a - b * b) / (b * b)
    big = 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q)))
    small = q / 1024 * (256 + q * (-128 + q * (74 - 47 * q)))
    delta = small * ss * (mid + small / 4 * (cs * (2 * mid * mid - 1) - small / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3)))
    return b * big * (sigma - delta)


def test_distance(spark):
    points = [(55.751999, 37.617734, la, lo) for la in (-80.5, -33.0, 0.0, 12.5, 55.751999, 89.9) for lo in (-179.0, -58.4, 0.0, 37.617734, 140.25)]
    points += [(0.0, 0.0, 0.0, 90.0), (10.0, 10.0, 10.0, 10.0)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    for r in geo.with_distance(df, (F.col("a"), F.col("b")), (F.col("c"), F.col("d")), "km").collect():
        assert r.km == pytest.approx(vincenty(r.a, r.b, r.c, r.d), abs=0.0051)


def test_reviews(spark):
    batch = '{"feedbacks":[{"text":"t","productValuation":5,"createdDate":"2020-01-02T00:00:00Z"},{"text":null}]}'
    pages = captured(spark, {"body": batch}, {"body": '{"feedbacks":null}'}, {"body": "x"})
    assert [(r.text, r.rating, r.created_at) for r in reviews.reviews(pages).orderBy("ord").collect()] == [("t", 5, "2020-01-02T00:00:00Z"), (None, None, None)]
    states = captured(spark, {"body": PRODUCT}, {"body": "<p>"}, {"body": "<script>wb.spa.init({router: x});</script>"})
    targets = reviews.review_targets(states)
    assert {(r.page_id, r.imt_id, r.feedbacks) for r in targets.collect()} == {(1, 70, 2001), (2, None, 0), (3, None, 0)}
    assert [(r.page_id, r.skip, r["take"]) for r in reviews.review_requests(targets).orderBy("skip").collect()] == [(1, 0, 1000), (1, 1000, 1000), (1, 2000, 1000)]
    scripts = spark.createDataFrame([(1, "wb.spa.init({router: x});"), (2, "wb.spa.init({router: {}});"), (3, "other"), (4, "wb.spa.init(")], "page_id int, s string")
    assert {r.page_id for r in reviews.rejected_states(scripts, "s").collect()} == {1, 4}
    dated = captured(spark, {"body": '<div class="comment"><i class="time" content="2020-01-01"></i></div><div class="comment"><i class="time" content="2021"></i></div>'}, {"body": '<div class="comment">no date</div>'}, {"body": "<p>"})
    assert {(r.page_id, r.wb_first_review_date) for r in reviews.first_review_date(dated).collect()} == {(1, "2020-01-01"), (2, None)}


def test_shops(spark):
    listing = captured(spark, {"url": "https://m.example/c?page=2", "body": '<h1>C</h1><div class="product"><div class="product__img" id="i1"><a class="product__a" href="/p/1?x"></a></div>'
                               '<div class="product__title"><a class="product__a">N</a></div><b class="prices__actual">5 р</b></div><div class="product"></div>'})
    found = shops.shop_listing(listing).orderBy("position").collect()
    assert tuple(found[0])[2:] == ("i1", "https://m.example/p/1", "C", "https://m.example/c", "N", "5 р")
    assert (found[1].id, found[1].name) == (None, None)
    detail = captured(spark, {"body": '<div class="details-sku"><b class="details-param-value"> S1 </b></div><i class="price-number">9</i><div class="details-carousel-item">'
                              '<img class="gallery-photos-item-obj" data-src="/xsmall/2.jpg"><img class="gallery-photos-item-obj" src=" /xsmall/1.jpg"></div>'}, {"body": "<p>"})
    rows = {r.page_id: r for r in shops.shop_product(detail).collect()}
    assert (rows[1].id, rows[1].price, rows[1].dimensions, rows[1].pictures) == ("S1", "9", None, ["/big/1.jpg", "/big/2.jpg"])
    assert (rows[2].id, rows[2].pictures) == (None, [])
    article = captured(spark, {"body": '<p><div class="prod--art">Артикул<span class="space"> </span> 77 </div><span itemprop="productID">V</span>'}, {"body": "<p>"})
    assert {(r.page_id, r.article, r.vendor_code) for r in shops.shop_article(article).collect()} == {(1, "77", "V"), (2, None, None)}
    tree = captured(spark, {"body": '<a class="menu-dropdown-link" href="/c">c</a><div class="product-categories"><a href="/d">d</a></div><a class="pagenumberer-next" href="/c?2">n</a>'})
    assert {(r.kind, r.dst) for r in shops.page_edges(tree).collect()} == {("menu", "https://s.example/c"), ("category", "https://s.example/d"), ("next", "https://s.example/c?2")}


def test_seeds_and_endpoints(spark, tmp_path):
    options = spark.createDataFrame(
        [("c1,c2", "g", None), (None, "g1, ,g2", None), (None, None, True), (None, None, None)],
        "category_url string, good_url string, use_sitemap boolean",
    ).withColumns({"sitemap_url": F.lit("s"), "menu_url": F.lit("m")})
    found = [(r.kind, r.url) for r in readers.seed_urls(options).collect()]
    assert found == [("category", "c1"), ("category", "c2"), ("product", "g1"), ("product", "g2"), ("sitemap", "s"), ("menu", "m")]
    with pytest.raises(ValueError):
        readers.require_seeds(readers.seed_urls(options.where("1 = 0")))
    (tmp_path / "list.txt").write_text("# no\n\n h:1 \nhttp://h:1\nhttps://g,f\n", encoding="utf8")
    lines = readers.endpoint_file(spark, str(tmp_path / "list.txt"))
    assert sorted(r.endpoint for r in lines.collect()) == ["http://f", "http://h:1", "https://g"]


def test_context_goes_through_redirects(spark):
    """A page that names another as canonical hands on the context of the edges to it, and its parent."""
    def page(key, kind, canonical=None):
        body = PRODUCT.replace("/catalog/7/", f"/catalog/{canonical or key}/").replace(" 7 ", f" {key} ")
        return {"url": f"https://s.example/catalog/{key}/detail.aspx", "kind": kind, "body": body}

    pages = captured(spark, page(7, None), page(8, "variant", 21), page(21, "variant"), page(30, "product", 7))
    edges = spark.createDataFrame([("https://s.example/catalog/30/detail.aspx", 1, 4, "c1", "C1")], "to_url string, from_page int, position int, category_url string, category_name string")
    reviews = spark.createDataFrame([], "product_url string, created_at timestamp")
    found = {r.wb_id: r for r in catalog.wb_products(pages, edges, reviews).collect()}
    assert set(found) == {7, 21}
    assert (found[7].wb_category_name, found[7].wb_category_position, found[7].wb_parent_id) == ("C1", 4, None)
    assert found[21].wb_parent_id == 7
    assert {r.wb_id for r in catalog.wb_products(pages, edges, reviews, skip_variants=True).collect()} == {7}


def test_position_from_the_edge_or_the_fullest_page(spark):
    rows = [("c", 2, i) for i in range(1, 4)] + [("c", 3, 1)]
    cards = spark.createDataFrame(rows, "wb_category_url string, page_no int, position int").withColumn("page_id", F.col("page_no"))
    found = {(r.page_no, r.position): r.wb_category_position for r in positions.by_offset(cards).collect()}
    assert found == {(2, 1): 4, (2, 2): 5, (2, 3): 6, (3, 1): 7}
    known = positions.by_offset(cards.withColumn("offset", F.when(F.col("page_no") == 3, 40)))
    assert {(r.page_no, r.position): r.wb_category_position for r in known.collect()}[3, 1] == 41 and "offset" not in known.columns


def test_processors_see_what_the_rule_found(spark):
    pages = captured(spark, {"url": "https://s.example/catalog/7/detail.aspx", "body": PRODUCT})
    found = catalog.wb_product_page(pages, processors={"price": lambda c: F.transform(c, lambda v: F.replace(v, F.lit("99"), F.lit("12")))}).first()
    assert found.wb_price == Decimal("12.00") and "12" in found.wb_price_raw


def test_processors_of_the_other_jobs(spark):
    each = lambda change: lambda texts: F.transform(texts, change)
    body = '{"data":{"products":[{"id":1,"name":" n ","brand":"b","feedbackCount":2,"salePrice":10.5}]}}'
    listed = catalog.wb_listing_json(captured(spark, {"url": "http://api.example/x", "body": body}), processors={"name": F.upper, "brand": F.reverse})
    assert [(r.product_name, r.wb_brand_name, r.wb_id) for r in listed.collect()] == [("N", "b", 1)]

    data = '<script type="application/ld+json">{"@type":"Product","name":"n","sku":"7","offers":{"Price":"12"}}</script>'
    page = catalog.ozon_product_page(captured(spark, {"body": data}), {"price": lambda c: F.concat(c, F.lit("0")), "sku": lambda c: F.concat(F.lit("s"), c)})
    assert [(r.ozon_id, r.ozon_price) for r in page.collect()] == [("s7", Decimal("120.00"))]

    menu_page = captured(spark, {"body": "<a href='/a'>x</a>"})
    assert catalog.menu_categories(menu_page, processors={"name": each(F.upper)}).first().wb_category_name == "X"
    brands = captured(spark, {"body": '<div class="i-brand-list"><a href="/b"><span>x</span></a></div>'})
    assert catalog.wb_brands(brands, {"name": each(F.upper)}).first().wb_brand_name == "X"
    maker = captured(spark, {"body": '<h1 class="cfix">m</h1>'})
    assert producers.producer_page(maker, processors={"name": each(F.upper)}).first().producer_name == "M"
    cards = captured(spark, {"body": '<div id="content"><div class="items"><div class="item"><a class="link" href="/p">p</a></div></div></div>'})
    assert producers.producer_cards(cards, processors={"href": each(lambda u: F.concat(u, F.lit("/q")))}).first().to_url == "https://s.example/p/q"
    goods = captured(spark, {"body": '<div class="product"><p class="prices__actual">5</p></div>'})
    assert shops.shop_listing(goods, processors={"price": each(lambda p: F.concat(p, F.lit(" RUB")))}).first().price == "5 RUB"
    with pytest.raises(ValueError, match="no such field: prise"):
        shops.shop_listing(goods, processors={"prise": F.upper})
