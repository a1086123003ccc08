"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Payment rows are derived once
and stored in as many files as there are cores, so that the stages and not the derivation are timed.
Each query writes its whole result to the ``noop`` sink; the best of three runs after a warm-up counts.
``BENCH_QUERIES`` names some of the queries, by commas.
"""

from __future__ import annotations

import json
import os
import time

from cardrail.operators import cdc, dead_letters, decryption, envelope, normalization, validation
from cardrail.plans import catalog, pipelines
from cardrail.plans.payments import INDEX, operations
from cardrail.schemas import RECORD_COLUMNS, TOPIC_NORMALIZED
from cardrail.session import build_session, scratch_path
from cardrail.sinks.store import Store
from cardrail.sources.topics import FolderTopic

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def best_of(run, runs: int = RUNS) -> float:
    """The best of ``runs`` after a warm-up; of a single run, that run."""
    times = []
    for _ in range(runs + (runs > 1)):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times[1:] or times), 3)


def consume(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_path(spark, "bench")
    key = catalog.sample_key(spark)

    def stored(name, df):
        path = f"{base}/{name}"
        df.repartition(int(CPUS)).write.parquet(path)
        return spark.read.parquet(path)

    rows = stored("rows", operations(spark, SF_DIR))
    changes = stored("changes", catalog.change_events(spark, SF_DIR))
    opened = envelope.as_envelopes(rows, INDEX, RECORD_COLUMNS, catalog.PRODUCED_MS)
    sealed = stored("sealed", envelope.seal(opened, key, now_ms=catalog.PRODUCED_MS))
    topic = FolderTopic(f"{base}/topics", TOPIC_NORMALIZED)
    records = pipelines.canonical_from_open(opened, catalog.NORMALIZED_MS)
    checked = validation.validate(opened, catalog.VALIDATED_MS)
    decrypted = decryption.decrypt(sealed, key, catalog.DECRYPTED_MS)
    canonical = stored("canonical", catalog.canonical(spark, SF_DIR))
    batches, store = iter(range(10_000)), Store(spark, f"{base}/store")

    queries = {
        "validate": consume(validation.accepted(checked)),
        "validation_errors": consume(dead_letters.one_per_error(validation.rejected(checked))),
        "canonical_flat": consume(normalization.flatten(records)),
        "seal": consume(envelope.seal(opened, key, now_ms=catalog.PRODUCED_MS)),
        "decrypt": consume(decryption.accepted(decrypted)),
        "pipeline_canonical": consume(
            normalization.flatten(pipelines.canonical_from_sealed(sealed, key, catalog.NORMALIZED_MS))
        ),
        "pipeline_dlq": consume(
            dead_letters.one_per_error(pipelines.rejects_from_sealed(sealed, key, catalog.VALIDATED_MS))
        ),
        "cdc_adapt": consume(cdc.adapt(changes, catalog.PRODUCED_MS)),
        "pipeline_cdc": consume(
            normalization.flatten(pipelines.canonical_from_changes(changes, catalog.NORMALIZED_MS))
        ),
        "topic_write": lambda: topic.append(
            records.select("msgId", normalization.canonical_text(records).alias("value")).withColumnRenamed(
                "msgId", "key"
            ),
            "bench",
            next(batches),
        ),
        "canonical_store": lambda: store.append(canonical),
    }
    asked = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else list(queries)
    times = {name: best_of(queries[name]) for name in asked}
    n = rows.count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "rows": n,
                "rows_per_second": {name: round(n / t) for name, t in times.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
