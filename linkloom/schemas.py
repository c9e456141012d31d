"""Table schemas of the crawl state and of the request bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.constants import DATA_TYPES, PAGE_TYPES

_S, _L, _I, _N, _B = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType(), T.BinaryType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


CODE = _struct(code=_S)
SITE = _struct(id=_L, domain=_S, robots_content=_S, sitemap_content=_S)
PAGE = _struct(
    id=_L, site_id=_L, page_type_code=_S, url=_S, html_content=_S, http_status_code=_I,
    accessed_time=_N, accessed_ip=_S, relevance=_I, content_hash=_S,
)
# A page without its text, which is a row of its own: (id, text_no) finds it, null is none.
PAGE_STATE = _struct(**{f.name: f.dataType for f in PAGE.fields if f.name != "html_content"}, text_no=_L)
PAGE_TEXT = _struct(id=_L, text_no=_L, html_content=_S)
PAGE_DATA = _struct(id=_L, page_id=_L, data_type_code=_S, data=_B)
IMAGE = _struct(id=_L, page_id=_L, filename=_S, content_type=_S, data=_B, accessed_time=_N)
LINK = _struct(from_page=_L, to_page=_L)
FETCHED = _struct(
    id=_L, url=_S, html=_S, http_status_code=_I, content_type=_S, accessed_ip=_S, accessed_time=_N,
)

TABLES = {
    "data_type": CODE, "page_type": CODE, "site": SITE, "page": PAGE,
    "page_data": PAGE_DATA, "image": IMAGE, "link": LINK, "page_state": PAGE_STATE, "page_text": PAGE_TEXT,
}

LINK_BATCH = _struct(from_page_id=_L, links=T.ArrayType(_struct(url=_S, relevance=_I)))


def page_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(code,) for code in PAGE_TYPES], CODE)


def data_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(code,) for code in DATA_TYPES], CODE)


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def fitted(df: DataFrame, table: str) -> DataFrame:
    """``df`` with just the columns of ``table``; those that it lacks are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[table].fields
    ])
