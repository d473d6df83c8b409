"""The newest rows per line, kept from run to run instead of searched for in the whole history.

The state holds, per line, the rows of its newest insert date, and the history's
versions it has taken in. A refresh reads the versions it doesn't know yet, one
after an ordinary run. A replaced run date takes its rows back out of the state;
lines that lose their newest rows that way look for older ones in the other run
dates, these lines only. The state is a versioned folder with a commit like the
history's, so a refresh that fails leaves the state as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.operators.relational import may_match, without_keys
from casework.operators.reports import SNAPSHOT_SOURCE, newest_days, newest_rows, with_suggested_price
from casework.session import tune
from casework.sources import files
from casework.sources.history import Commit, commits, read_versions
from casework.sources.schemas import RUN_DATE
from casework.sources.staging import Staging

_STATE_COLUMNS = "sequence bigint, version string, taken map<string,string>"
KEY = "acct_item_key"


def _newest_state(spark: SparkSession, path: str) -> tuple[int, str | None, dict[str, str]]:
    if not files.children(spark, f"{path}/commits"):
        return 0, None, {}
    found = spark.read.schema(_STATE_COLUMNS).parquet(f"{path}/commits").collect()
    return tuple(max(found, key=lambda r: (r.sequence, r.version)))


def _state_rows(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows/version={version}")


def _rows(spark: SparkSession, history_path: str, chosen: list[Commit]) -> DataFrame:
    return read_versions(spark, history_path, chosen).select(*SNAPSHOT_SOURCE, RUN_DATE)


def refresh_snapshot(spark: SparkSession, history_path: str, path: str) -> DataFrame:
    """Take the history's new versions into the state at ``path`` and return the snapshot."""
    tune(spark)
    sequence, version, taken = _newest_state(spark, path)
    current = {c.run_date.isoformat(): c for c in commits(spark, history_path)}
    changed = [d for d, c in current.items() if taken.get(d) != c.version]
    if version is not None and not changed:
        return read_snapshot(spark, path)
    replaced = [d for d in changed if d in taken]
    fresh_rows = _rows(spark, history_path, [current[d] for d in changed])
    others = _rows(spark, history_path, [c for d, c in current.items() if d not in changed]) if replaced else None

    def merged(cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The rows among which the newest are, each source passed through ``cut`` before it is joined."""
        rows = cut(fresh_rows)
        if version is None:
            return rows
        before = _state_rows(spark, path, version)
        state = cut(before)
        if replaced:
            lost = before.filter(F.date_format(RUN_DATE, "yyyy-MM-dd").isin(replaced)).select(KEY).distinct()
            state = without_keys(state, KEY, lost).unionByName(cut(others).join(lost, KEY, "left_semi"))
        return state.unionByName(rows)

    # The dates are found from two columns; of the wide rows only those that may have one are shuffled.
    staging = Staging(spark)
    days = staging.stage(newest_days(merged(lambda rows: rows.select(KEY, "insrt_dt"))), "days")
    found = newest_rows(merged(lambda rows: may_match(rows, days, [KEY, "insrt_dt"])))
    fresh = f"{sequence + 1:08d}-{uuid.uuid4().hex}"
    try:
        found.write.option("compression", "zstd").parquet(f"{path}/rows/version={fresh}")
    finally:
        staging.clear()
    row = (sequence + 1, fresh, {d: c.version for d, c in current.items()})
    spark.createDataFrame([row], _STATE_COLUMNS).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    if version is not None:
        sweep_states(spark, path, keep=(version, fresh))
    return read_snapshot(spark, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot as of the last refresh."""
    _, version, _ = _newest_state(spark, path)
    if version is None:
        raise ValueError(f"no snapshot at {path}: refresh it first")
    return with_suggested_price(_state_rows(spark, path, version))


def sweep_states(spark: SparkSession, path: str, keep: tuple[str, ...]) -> None:
    """Remove states older than those named; the one before stays for its readers."""
    for name in files.children(spark, f"{path}/rows"):
        if name.removeprefix("version=") not in keep:
            files.delete(spark, f"{path}/rows/{name}")
