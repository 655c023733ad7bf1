"""JSON bodies and JSON inside markup, read on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import collections as C
from pagemart.functions import text as X
from pagemart.sources import schemas as S

# Scripts pass plain objects written as JavaScript: names without quotes, single quotes.
_LENIENT = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}


def products(body: Column) -> Column:
    return F.from_json(body, S.PRODUCT_LISTING)["data"]["products"]


def widget_page(body: Column) -> Column:
    return F.from_json(body, S.WIDGETS)


def widget_items(page: Column) -> Column:
    """Items of the product widget, whose state is JSON text inside the page's JSON."""
    state = C.key_containing(page["widgetStates"], K.OZON_WIDGET_KEY)
    return F.from_json(state, S.WIDGET_ITEMS)["items"]


def feedbacks(body: Column) -> Column:
    return F.from_json(body, S.REVIEW_BATCH)["feedbacks"]


def ld_product(body: Column) -> Column:
    """The first JSON-LD block of type Product. A script may hold one block or a list of them."""
    scripts = F.regexp_extract_all(
        body, F.lit(r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1)
    )
    blocks = F.flatten(
        F.transform(
            scripts,
            lambda s: F.coalesce(
                F.from_json(
                    F.when(X.strip(s).startswith("["), s).otherwise(F.concat(F.lit("["), s, F.lit("]"))),
                    f"array<struct<{_fields(S.LD_PRODUCT)}>>",
                ),
                F.array().cast(f"array<struct<{_fields(S.LD_PRODUCT)}>>"),
            ),
        )
    )
    return C.first_match(blocks, lambda b: b["@type"] == "Product")


def _fields(ddl: str) -> str:
    """Top-level ``name type`` pairs rewritten as struct fields."""
    parts, depth, word = [], 0, ""
    for letter in ddl:
        depth += (letter == "<") - (letter == ">")
        if letter == "," and depth == 0:
            parts.append(word)
            word = ""
        else:
            word += letter
    return ", ".join(p.strip().replace(" ", ": ", 1) for p in [*parts, word])


def state_text(script: Column, call: str) -> Column:
    """The object passed to an init call in a script, as text."""
    return X.script_argument(X.collapse_script(script), call)


def state_v1(script: Column) -> Column:
    return F.from_json(state_text(script, "wb.product.DomReady.init"), S.STATE_V1, _LENIENT)


def state_v2(script: Column) -> Column:
    return F.from_json(state_text(script, "wb.spa.init"), S.STATE_V2, _LENIENT)


def orders_count(v1: Column, v2: Column, product_id: Column) -> Column:
    """Orders of the product: the older state's entry for it, else the selected one of the newer."""
    listed = F.try_element_at(v1["data"]["nomenclatures"], product_id)["ordersCount"]
    return F.coalesce(listed, v2["router"]["ssrModel"]["selectedNomenclature"]["ordersCount"])
