"""Hand-made records."""

from tidemart.schemas import LOG
from pyspark.sql import types as T

LOG_WITH_SEQ = T.StructType(LOG.fields + [T.StructField("seq", T.LongType())])


def page(mid, ts, seq, last=None, is_new="0", page_id="home", item=None, item_type=None,
         displays=None, start=None, during=1):
    return ((mid, "v1", "c1", "a1", is_new), (page_id, last, during, item, item_type),
            displays, start, ts, seq)


def pages(spark, rows):
    return spark.createDataFrame(rows, LOG_WITH_SEQ)


def seqs(df):
    return sorted(row.seq for row in df.select("seq").collect())
