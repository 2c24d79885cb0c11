"""Entity schemas and the rules that type raw text into them.

Each field is declared once as ``(name, type, rule)``.  The rule says how the
loader in :mod:`vitrine.operators.conform` turns raw text into the value.  Names
and types are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STR, DBL, INT, BIG, BOOL = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()
STRS = T.ArrayType(STR)
VARIANTS = T.MapType(STR, T.VariantType())


@dataclass(frozen=True)
class Entity:
    name: str
    fields: tuple[tuple[str, T.DataType, str], ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t, _ in self.fields])

    @property
    def columns(self) -> list[str]:
        return [n for n, _, _ in self.fields]


PRICE_DATA = Entity("price_data", (
    ("current", DBL, "price"),
    ("original", DBL, "price"),
    ("sale_tag", STR, "strip"),
    ("currency", STR, "strip:RUB"),
))

STOCK = Entity("stock", (
    ("in_stock", BOOL, "bool"),
    ("count", INT, "number"),
    ("status", STR, "strip"),
    ("available_regions", STRS, "keep"),
))

ASSETS = Entity("assets", (
    ("main_image", STR, "strip"),
    ("gallery_images", STRS, "keep"),
    ("view_360", STRS, "keep"),
    ("video", STRS, "strip_each"),
    ("cached_images", STRS, "keep"),
))

PRODUCT = Entity("product", (
    ("product_id", STR, "strip"),
    ("name", STR, "title"),
    ("category_id", STR, "strip"),
    ("category", STR, "strip"),
    ("subcategory", STR, "strip"),
    ("price_data", PRICE_DATA.schema, "keep"),
    ("price", DBL, "price"),
    ("original_price", DBL, "price"),
    ("discount_percentage", INT, "number"),
    ("currency", STR, "strip:RUB"),
    ("volume", STR, "strip"),
    ("alcohol_content", DBL, "float"),
    ("product_type", STR, "strip"),
    ("brand", STR, "title"),
    ("country", STR, "strip"),
    ("year", STR, "number"),
    ("description", STR, "strip"),
    ("tasting_notes", STR, "strip"),
    ("food_pairing", STR, "strip"),
    ("stock_data", STOCK.schema, "keep"),
    ("in_stock", BOOL, "bool"),
    ("stock_quantity", INT, "number"),
    ("availability_status", STR, "strip"),
    ("rating", DBL, "float"),
    ("review_count", INT, "number"),
    ("average_rating", DBL, "float"),
    ("assets", ASSETS.schema, "keep"),
    ("image_url", STR, "strip"),
    ("image_urls", STRS, "keep"),
    ("images", STRS, "keep"),
    ("region", STR, "strip:krasnodar"),
    ("product_url", STR, "strip"),
    ("sku", STR, "strip"),
    ("barcode", STR, "strip"),
    ("scraped_at", BIG, "number"),
    ("source", STR, "strip"),
    ("store_id", STR, "strip"),
    ("marketing_tags", STRS, "keep"),
    ("tags", STRS, "keep"),
    ("attributes", VARIANTS, "keep"),
    ("scraper_notes", STR, "strip"),
    ("validation_errors", STRS, "keep"),
    ("is_valid", BOOL, "bool"),
))

CATEGORY = Entity("category", (
    ("category_id", STR, "strip"),
    ("name", STR, "title"),
    ("description", STR, "strip"),
    ("url", STR, "strip"),
    ("product_count", INT, "number"),
    ("parent_category", STR, "strip"),
    ("image_url", STR, "strip"),
    ("scraped_at", BIG, "number"),
))

STORE = Entity("store", (
    ("store_id", STR, "strip"),
    ("name", STR, "title"),
    ("address", STR, "strip"),
    ("city", STR, "strip"),
    ("phone", STR, "strip"),
    ("website", STR, "strip"),
    ("latitude", DBL, "float"),
    ("longitude", DBL, "float"),
    ("scraped_at", BIG, "number"),
))

PRICE_HISTORY = Entity("price_history", (
    ("product_id", STR, "strip"),
    ("price", DBL, "price"),
    ("discount_percentage", INT, "number"),
    ("in_stock", BOOL, "bool"),
    ("region", STR, "strip"),
    ("timestamp", STR, "strip"),
    ("store_id", STR, "strip"),
))

REVIEW = Entity("review", (
    ("review_id", STR, "strip"),
    ("product_id", STR, "strip"),
    ("rating", INT, "number"),
    ("text", STR, "strip"),
    ("reviewer_name", STR, "title"),
    ("date", STR, "strip"),
    ("helpful_count", INT, "number"),
    ("verified_purchase", BOOL, "bool"),
    ("scraped_at", BIG, "number"),
))

ERROR = Entity("error", (
    ("error_id", STR, "strip"),
    ("error_type", STR, "strip"),
    ("message", STR, "strip"),
    ("url", STR, "strip"),
    ("spider_name", STR, "strip"),
    ("traceback", STR, "strip"),
    ("timestamp", STR, "strip"),
    ("severity", STR, "strip:INFO"),
))

ENTITIES = {
    e.name: e
    for e in (PRODUCT, PRICE_DATA, STOCK, ASSETS, CATEGORY, STORE, PRICE_HISTORY, REVIEW, ERROR)
}
