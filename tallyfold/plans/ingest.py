"""The write path: request bodies to state table and audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyfold.functions.classes import MEMORY
from tallyfold.operators.audit import audit_bodies
from tallyfold.operators.fold import fold_updates
from tallyfold.operators.validate import APPLY_PREFIX, REJECT_BATCH, applied_updates, judge_batches
from tallyfold.sinks.audit_log import append_audit
from tallyfold.sinks.state_table import upsert_state
from tallyfold.sources.updates import parse_batches


def ingest_bodies(
    requests: DataFrame,
    state_path: str,
    audit_path: str,
    staging_path: str,
    writer: str,
    epoch: int,
    on_invalid: str | None = None,
    store: str = MEMORY,
    key: str = "",
) -> None:
    """Apply ``requests(batch_id, ts, client, digest, body)`` and audit the accepted.

    Bodies are parsed and judged once; the verdicts are written to ``staging_path``
    so that fold and audit read only the columns they need and a lost executor
    costs no second parse. A batch with a bad update is applied up to it in the memory
    store and not at all in the table store, unless ``on_invalid`` says otherwise.
    """
    on_invalid = on_invalid or (APPLY_PREFIX if store == MEMORY else REJECT_BATCH)
    spark = requests.sparkSession
    judged = judge_batches(parse_batches(requests), on_invalid, store, key)
    judged.drop("body", "digest", "malformed").write.mode("overwrite").parquet(staging_path)
    staged = spark.read.parquet(staging_path)
    upsert_state(fold_updates(applied_updates(staged)), state_path, writer, epoch)
    append_audit(audit_bodies(staged), audit_path, writer, epoch)
