"""Records from a stream of pages: each micro-batch is parsed, joined with the index, and appended if its key is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.functions.text import item_of_href
from weftline.operators.dedupe import keep_first
from weftline.operators.incremental import pending
from weftline.operators.records import assemble
from weftline.sources import files
from weftline.sources.pages import parse_detail, spread

PAGE = files.strings("url", "html")


def stream_records(spark: SparkSession, pages_dir: str, index: DataFrame, out_dir: str, checkpoint_dir: str, image_base: str = "") -> StreamingQuery:
    """Append records to out_dir as Tamil pages (parquet files of url and html) arrive. A batch that is run again after a crash appends nothing twice: its keys are in out_dir already, and files appear only when their job commits."""
    stream = spark.readStream.schema(PAGE).parquet(pages_dir)

    def take(batch: DataFrame, _: int) -> None:
        asked = spread(batch.withColumn("temple_id", item_of_href(F.col("url"))).where("temple_id is not null"))
        parsed = asked.select("temple_id", "url", parse_detail(image_base)("html").alias("page")).where("page.found")
        one = keep_first(parsed.select("temple_id", "url", F.to_json("page").alias("page")), ["temple_id"], ["url"]).select("temple_id", F.from_json("page", parsed.schema["page"].dataType).alias("page"))
        done = files.read_jsonl(spark, out_dir, files.record_schema())[0]
        todo = pending(index.select("temple_id", "district_id", "district_name"), done, ["temple_id"])
        files.append(assemble(todo, one, one.where("false")), out_dir)

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
