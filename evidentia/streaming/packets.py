"""Packets decided as they arrive: an extension, as a packet is whole in itself and needs no state between batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from evidentia import dims
from evidentia.operators import evidence as E
from evidentia.operators import policy as P
from evidentia.sources.rows import write_rows

CANDIDATES = "case_id string, cand_ord long, page_index int, fld string, value string, tier_x10 int, source string, conf_bp int"
FEE_ROWS = "case_id string, cand_ord long, page_index int, tier_x10 int, source string, conf_bp int, status string, amount_raw string, waiver string"
FLAGS = "case_id string, flag_ord long, flags_text string, parsed_ok boolean, source string, conf_bp int"
FINDINGS = "case_id string, find_ord long, label string, template_only boolean, template string, source string, conf_bp int"
PACKETS = f"case_id string, candidates array<struct<{CANDIDATES.replace(' ', ':').replace(',:', ', ')}>>, fee_rows array<struct<{FEE_ROWS.replace(' ', ':').replace(',:', ', ')}>>, flags array<struct<{FLAGS.replace(' ', ':').replace(',:', ', ')}>>, findings array<struct<{FINDINGS.replace(' ', ':').replace(',:', ', ')}>>"


def decide_batch(packets: DataFrame) -> DataFrame:
    """Emitted rows of packets (PACKETS), each with its candidates, fee rows, flags and findings."""
    part = lambda c: packets.select(F.explode(c).alias("e")).select("e.*")
    evidence = E.reconcile(part("candidates"), part("fee_rows"), part("flags"), part("findings"), packets.select("case_id").distinct())
    return P.build_row(P.decide(P.template_rescue(P.cascade(evidence)), dims.path_stats(packets.sparkSession)))


def watch(spark: SparkSession, folder: str, to: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Decides JSON packets that arrive in folder. A batch's rows go to a folder of its number, so one that is run again replaces its own."""
    stream = spark.readStream.schema(PACKETS).json(folder)
    out = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, n: write_rows(decide_batch(batch), f"{to}/batch={n}"))
    return (out.trigger(availableNow=True) if once else out.trigger(processingTime="10 seconds")).start()
