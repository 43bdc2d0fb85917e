"""Command line: ``python -m turnout reports|stream ...``.

``reports`` publishes every report bundle of a data directory once; ``stream`` runs the live job
(decode, minute counts, forecast, upsert, bundles per micro-batch) from Kafka or a Parquet log,
resuming from its checkpoint.  Cluster settings (master, memory, checkpoint dir) come from
``spark-submit``; only unset ones get local defaults.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from turnout.session import ENGINE_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.appName("turnout")
    spark = b.getOrCreate()
    for k, v in ENGINE_CONF.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def _dimension_arguments(p: argparse.ArgumentParser) -> None:
    p.add_argument("--nation-doc", help="registered voters of the nation (JSON lines; give all three or none)")
    p.add_argument("--region-doc", help="registered voters per region")
    p.add_argument("--wilayat-doc", help="registered voters per wilayat")
    p.add_argument("--areas", help="CSV with header: area_l1, l1_name, area_l2, l2_name")
    p.add_argument("--registered-ages", help="CSV with header: age, n (registered voters per year of age)")


def given_dimensions(spark: SparkSession, a: argparse.Namespace) -> dict:
    """The dimensions that files were named for, as ``Inputs`` takes them; the data directory has the rest."""
    from turnout import constants as C
    from turnout.sources import dims
    given = {}
    docs = {C.LEVEL_NATION: a.nation_doc, C.LEVEL_L1: a.region_doc, C.LEVEL_L2: a.wilayat_doc}
    if any(docs.values()):
        if not all(docs.values()):
            raise SystemExit("give --nation-doc, --region-doc and --wilayat-doc together")
        given["registered_tables"] = {level: dims.read_registered(spark, path, level) for level, path in docs.items()}
    if a.areas:
        table = spark.read.csv(a.areas, header=True, schema="area_l1 long, l1_name string, area_l2 long, l2_name string")
        given["area_table"] = table.withColumns({c: dims.clean_name(table[c]) for c in ("l1_name", "l2_name")})
    if a.registered_ages:
        given["registered_age_counts"] = spark.read.csv(a.registered_ages, header=True, schema="age long, n long")
    return given


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="turnout")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("reports", help="publish all report bundles of a data directory")
    r.add_argument("--data-dir", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--batch-id", type=int, default=0)
    s = sub.add_parser("stream", help="run the live job")
    s.add_argument("--data-dir", required=True, help="registered voters and area dimensions")
    s.add_argument("--state-dir", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--kafka-bootstrap")
    s.add_argument("--topic")
    s.add_argument("--log-path", help="Parquet log folder instead of Kafka")
    s.add_argument("--trigger-seconds", type=int, default=25)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--max-offsets-per-trigger", type=int, help="most messages of a micro-batch (Kafka)")
    s.add_argument("--max-files-per-trigger", type=int, help="most log files of a micro-batch (Parquet log)")
    s.add_argument("--forecast-from", choices=["batch", "running"], default="batch")
    for command in (r, s):
        _dimension_arguments(command)
    a = p.parse_args(argv)

    spark = _session()
    from turnout.plans.charts import bundles, write_reports
    from turnout.plans.inputs import Inputs
    given = given_dimensions(spark, a)
    if a.cmd == "reports":
        write_reports(bundles(Inputs(spark, a.data_dir, **given), a.batch_id), a.out)
        return
    from turnout.streaming.pipeline import run_live_pipeline
    if a.kafka_bootstrap:
        source = {"kafka.bootstrap.servers": a.kafka_bootstrap, "subscribe": a.topic, "startingOffsets": "earliest"}
        if a.max_offsets_per_trigger:
            source["maxOffsetsPerTrigger"] = str(a.max_offsets_per_trigger)
    else:
        source = {"path": a.log_path}
        if a.max_files_per_trigger:
            source["maxFilesPerTrigger"] = a.max_files_per_trigger
    trigger = {"availableNow": True} if a.available_now else {"processingTime": f"{a.trigger_seconds} seconds"}
    q = run_live_pipeline(spark, source, a.state_dir, a.checkpoint, Inputs(spark, a.data_dir, **given).dim,
                          trigger=trigger, data_dir=a.data_dir, forecast_from=a.forecast_from, dims=given)
    q.awaitTermination()


if __name__ == "__main__":
    main()
