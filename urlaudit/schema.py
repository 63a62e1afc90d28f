"""Schemas of the tables the engine reads and writes."""

from pyspark.sql.types import (
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

LONG, INT, TEXT, FLAG, TIME = LongType(), IntegerType(), StringType(), BooleanType(), TimestampNTZType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


URL = _table(id=LONG, name=TEXT, group_key=TEXT, valid=FLAG, priority=INT)
STATUS = _table(
    url_id=LONG,
    category=TEXT,
    message=TEXT,
    checking_date=TIME,
    status_code=INT,
    content_type=TEXT,
    content_length=LONG,
    duration=INT,
    redirect_count=INT,
    method=TEXT,
)
URL_CONTEXT = _table(url_id=LONG, context_id=LONG, ingestion_date=TIME, active=FLAG)
RESPONSES = _table(
    url=TEXT,
    method=TEXT,
    status_code=INT,
    location=TEXT,
    headers=MapType(TEXT, TEXT),
    exception_class=TEXT,
    cause_class=TEXT,
    exception_message=TEXT,
    duration_ms=LONG,
)
ROBOTS_RULES = _table(host=TEXT, rule=TEXT, path_prefix=TEXT, crawl_delay_ms=LONG)
HOST_OVERRIDES = _table(host=TEXT, delay_ms=LONG, timeout_ms=LONG)

STATUS_COLUMNS = STATUS.fieldNames()
