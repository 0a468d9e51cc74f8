"""Item record schema, kept columns and the label domain."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()
_TEXTS = T.ArrayType(T.StringType())

# Every field of a scoring request, in the order in which problems are reported.
REQUEST = T.StructType(
    [
        T.StructField("asin", _TEXT),
        T.StructField("title", _TEXT),
        T.StructField("brand", _TEXT),
        T.StructField("description", _TEXTS),
        T.StructField("feature", _TEXTS),
        T.StructField("category", _TEXTS),
        T.StructField("also_buy", _TEXTS),
        T.StructField("also_view", _TEXTS),
        T.StructField("image", _TEXTS),
        T.StructField("price", _TEXT),
    ]
)

LABEL = "main_cat"
KEY = "asin"
TEXT = "combined_text"

# A stored record is a request plus its label.
PRODUCT = T.StructType([*REQUEST.fields, T.StructField(LABEL, _TEXT)])

# Column order decides the order of the combined text.
KEPT = ["asin", "title", "description", "feature", "brand", "main_cat"]

# The label domain. A label's code is its position.
LABELS = [
    "All Electronics",
    "Amazon Fashion",
    "Amazon Home",
    "Arts, Crafts & Sewing",
    "Automotive",
    "Books",
    "Camera & Photo",
    "Cell Phones & Accessories",
    "Computers",
    "Digital Music",
    "Grocery",
    "Health & Personal Care",
    "Home Audio & Theater",
    "Industrial & Scientific",
    "Movies & TV",
    "Musical Instruments",
    "Office Products",
    "Pet Supplies",
    "Sports & Outdoors",
    "Tools & Home Improvement",
    "Toys & Games",
    "Video Games",
]
