"""Batch job: raw invoice lines -> silver -> gold and analysis tables.

    spark-submit souk/jobs/build_tables.py --input <raw.csv or dir> --out-base <path> \
        [--format parquet|delta|csv|tsv] [--input-format csv|tsv|parquet] [--mode overwrite|append] [--batch <id>] \
        [--overwrite static|dynamic] [--clustering rebalance|repartition] [--run-ml]
    spark-submit souk/jobs/build_tables.py --silver <base>/silver/transactions_clean --out-base <path>
    spark-submit souk/jobs/build_tables.py --sf-dir /root/testdata/sf0.1 --out-base <path>

The raw input is read once, into a staged table (every row, typed, with its
texts and the verdict of the quality rules). Silver is a filter of it, the
tables over raw lines read it, and a table that others need is read back once
written, so a lost executor recomputes from files. ``--silver`` starts from an
existing silver table and writes what needs no raw lines. Session settings are
the job's, never the library's.

Gold is made from mergeable states under ``<out-base>/state`` (see
``operators.state`` and ``sources.versions``). ``--mode append`` aggregates the
new rows alone, merges them into the states of the months they touch, appends
them to silver and makes gold anew from the states; tables with a row per month
and basket or line are rewritten for the touched months only. The tables over
raw lines are made from the lines of all runs. Appending A and then B gives
what one build of both gives. A ``--batch`` that was committed isn't applied
again; one that broke off is taken up, its rows neither lost nor doubled.
"""

from __future__ import annotations

import argparse
import re
import sys
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from souk.functions import customer_present, year_month_from_text  # noqa: E402
from souk.operators import clean as C  # noqa: E402
from souk.operators import clusters as CL  # noqa: E402
from souk.operators import freq as FQ  # noqa: E402
from souk.operators import joins as J  # noqa: E402
from souk.operators import kpis as K  # noqa: E402
from souk.operators import layout as L  # noqa: E402
from souk.operators import model as M  # noqa: E402
from souk.operators import sampling as S  # noqa: E402
from souk.operators import state as ST  # noqa: E402
from souk.schema import RAW_SCHEMA, SILVER_SCHEMA  # noqa: E402
from souk.session import ensure_checkpoint_dir, staging_session  # noqa: E402
from souk.sources import io  # noqa: E402
from souk.sources.fixture import transactions_raw  # noqa: E402
from souk.sources.versions import Versions  # noqa: E402

FORMATS = ["parquet", "delta", "csv", "tsv"]
SILVER = "silver/transactions_clean"


def parse_args(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="raw invoice lines (CSV with a header, or --input-format)")
    src.add_argument("--sf-dir", help="star-schema test tables; the raw view is derived from them")
    src.add_argument("--silver", help="an existing silver table in --format; no raw line is read")
    p.add_argument("--input-format", default="csv", choices=["csv", "tsv", "parquet"])
    p.add_argument("--multi-line", action="store_true", help="raw CSV values may hold line breaks")
    p.add_argument("--out-base", required=True)
    p.add_argument("--format", default="parquet", choices=FORMATS)
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--batch", help="name of this input; a committed one isn't applied again (default: a new name)")
    p.add_argument("--overwrite", default="static", choices=["static", "dynamic"])
    p.add_argument("--clustering", default="rebalance", choices=["rebalance", "repartition"])
    p.add_argument("--year", type=int, default=None, help="year of the pruned mall x month table")
    p.add_argument("--min-cluster", type=int, default=10, help="edge threshold of the cluster tables")
    p.add_argument("--run-ml", action="store_true")
    args = p.parse_args(argv)
    if args.silver and args.mode == "append":
        p.error("--silver is a whole table; append new rows with --input")
    if args.batch and not re.fullmatch(r"[A-Za-z0-9_.-]+", args.batch):
        p.error("--batch names a folder: letters, digits and _.- only")
    return args


def session() -> SparkSession:
    spark = (
        SparkSession.builder.appName("souk-build-tables")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    ensure_checkpoint_dir(spark)
    return spark


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as JSON text, for sinks that only take flat columns."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else f.name for f in df.schema])


def read_raw(spark: SparkSession, args) -> DataFrame:
    if args.sf_dir:
        return transactions_raw(spark, args.sf_dir)
    if args.input_format == "parquet":
        return io.read_table(spark, args.input, "parquet")
    sep = "\t" if args.input_format == "tsv" else ","
    return io.read_transactions(spark, args.input, RAW_SCHEMA, sep, args.multi_line, malformed=C.MALFORMED)


class Tables:
    """Where the job writes its tables, and reads them back from. ``months``:
    those that this run touched, null if the tables are built anew."""

    def __init__(self, spark: SparkSession, args, months: list[str | None] | None = None):
        self.spark, self.args, self.months = spark, args, months
        self.base = args.out_base.rstrip("/")
        self.written: dict[str, str] = {}

    def save(self, name: str, df: DataFrame) -> None:
        path = f"{self.base}/{name}"
        text = self.args.format in ("csv", "tsv")
        io.write_table(_flat(df) if text else df, path, fmt=self.args.format)
        self.written[name] = path

    def save_months(self, name: str, df: DataFrame) -> None:
        """A table with its month as partition column; of one that is there
        only the touched months are written. Text is written whole."""
        if self.args.format in ("csv", "tsv"):
            return self.save(name, df)
        overwrite = "static" if self.months is None else "dynamic"
        if self.months is not None:
            df = df.where(in_months(self.months))
        path = f"{self.base}/{name}"
        io.write_table(io.clustered_for_write(df, [ST.MONTH]), path, fmt=self.args.format, partition_by=[ST.MONTH], overwrite=overwrite)
        self.written[name] = path

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return io.read_table(self.spark, self.written[name], self.args.format, schema=schema).select(*schema.names)

    def keep(self, name: str, df: DataFrame, by_month: bool = False) -> DataFrame:
        """Saves a table that others are made from and reads it back."""
        (self.save_months if by_month else self.save)(name, df)
        return self.read(name, df.schema)


def in_months(months: list[str | None]):
    """Rows of these months, where null is one."""
    own = F.col(ST.MONTH).isin([m for m in months if m is not None])
    return F.coalesce(own, F.lit(None in months))


def gold(out: Tables, s: DataFrame, states: Versions, args) -> DataFrame:
    """Tables over silver, from the states. Returns the mall dimension."""
    state = {name: states.state(name, st, s) for name, st in ST.STATES.items()}
    customers = out.keep("gold/customer_summary", ST.customer_summary(state["customers"], state["customer_prices"]))
    out.save("gold/customer_summary_money", ST.customer_summary_money(state["customers"]))
    out.save("gold/bucket_counts", K.bucket_counts(customers))
    out.save("gold/monthly_summary", ST.monthly_summary(state["malls"]))
    category = out.keep("gold/category_avg_spend", ST.category_avg_spend(state["categories"]))
    top = [F.desc("avg_spend_per_tx"), F.asc("category")]
    io.write_small_csv(category, f"{out.base}/gold/category_top10", 10, top)
    out.written["gold/category_top10"] = f"{out.base}/gold/category_top10"

    out.save("gold_b/mall_month_extended", ST.mall_month_extended(state["baskets"]))
    out.save("gold_b/age_band_category", ST.age_band_category(state["bands"]))
    out.save("gold_b/payment_behavior", ST.payment_behavior(state["payments"]))
    out.save("gold_b/mall_agg_skewed", ST.mall_revenue(state["malls"]))
    out.save("gold_b/mall_agg_balanced", ST.mall_revenue(state["malls"]).coalesce(8))
    by_month = out.keep("gold_b/mall_month_baseline", ST.mall_revenue(state["malls"], "shopping_mall", ST.MONTH))
    if args.year is not None:
        out.save("gold_b/mall_month_optimized", by_month.where(L.year_filter(args.year)))
    # the malls come from the counts, not from another pass over silver
    malls = out.keep("gold_b/mall_counts", ST.mall_counts(state["malls"]))
    dim = out.keep("gold_b/mall_dimension", J.mall_dimension(malls))
    out.save_months("gold_b/join_regular", J.join_mall_dim(s, dim, "merge"))
    out.save_months("gold_b/join_broadcast", J.join_mall_dim(s, dim, "broadcast"))
    rows = out.keep("gold_b/invoice_baskets", ST.invoice_baskets(state["baskets"]), by_month=True)
    if args.run_ml:
        model, test = M.HIGH_SPEND_BASKETS.fit_split(M.basket_features(rows, dim), "invoice_no")
        out.save("gold_b/ml_predictions", M.predictions(model, test))
        out.save("gold_b/ml_auc", M.auc_table(M.predictions(model, test, flat=False)))
    return dim


def over_raw_lines(out: Tables, stage: DataFrame, args) -> None:
    """Tables over all raw lines, from the staged table."""
    texts = C.texts_of(stage)
    for c in ("category", "payment_method", "gender", "shopping_mall"):
        out.save(f"frequencies/freq_{c}", FQ.frequency(texts, c))
    for c in ("age", "shopping_mall"):
        out.save(f"frequencies/top5_{c}", FQ.top_values(texts, c, 5))
    out.save("frequencies/missing_fields", FQ.missing_fields(texts))
    out.save("frequencies/text_profile", FQ.text_profile(texts))
    out.save("customers/demographics", C.customer_demographics(texts))
    out.save("customers/customer_counts", FQ.customer_counts(texts))
    out.save("customers/first_gender", FQ.first_per_key(texts.where(customer_present()), "customer_id", "gender", ["invoice_no"]))
    out.save("customers/top_customers_with_gender", FQ.top_customers_with_gender(texts, 10))
    out.save("customers/top_customers_by_quantity", K.top_customers_by_quantity(stage, 10))
    out.save("lines/malformed", C.malformed_lines(stage))
    out.save("lines/skinny", C.skinny_transactions(C.clean_fields(texts)))
    out.save("lines/sample", S.sample_rows(texts, 1000))

    out.save("signals/numeric_distributions", K.numeric_distributions(stage))
    out.save("signals/signals_ranked", K.signals_ranked(stage))
    out.save("signals/monthly_summary_raw", K.monthly_summary(stage))
    split = stage.where(F.col("invoice_date").rlike(r"^[0-9]+/[0-9]+/[0-9]{4}$"))
    split = split.withColumn("year_month", year_month_from_text("invoice_date"))
    out.save("signals/monthly_summary_by_split", K.monthly_summary(split))

    edges = CL.category_customer_edges(texts)
    counts = out.keep("clusters/entity_counts", CL.entity_counts(edges, args.min_cluster))
    kept = out.keep("clusters/edges_thresholded", CL.threshold_edges(edges, counts))
    out.save("clusters/cluster_sizes", CL.cluster_sizes(kept))
    out.save("clusters/cluster_outcomes", CL.cluster_outcomes(CL.category_prices(texts)))
    overall = out.keep("clusters/top30_overall", CL.top_entities(edges, 30))
    clusters = out.keep("clusters/top30_clusters", CL.top_entities(kept, 30))
    out.save("clusters/top30_diff", CL.top_diff(clusters, overall))
    out.save("clusters/edge_sample", S.edge_sample(texts, 500))
    out.save("clusters/edge_nodes", CL.edge_nodes(kept))


def months_of(rows: DataFrame) -> list[str | None]:
    return [r[0] for r in rows.select(ST.MONTH).distinct().collect()]


def append_once(spark: SparkSession, rows: DataFrame, path: str, states: Versions, batch: str, args) -> int:
    """Appends to silver, also when the run is started again: silver holds the
    rows of all committed batches, and those of this one or not yet."""
    new, before = rows.count(), sum(states.batches.values())
    there = io.read_table(spark, path, args.format, schema=SILVER_SCHEMA).count() if io.exists(spark, path) else 0
    intent = f"{states.base}/intents/{batch}"
    if there == before + new and io.exists(spark, intent):
        return new
    if there != before:
        raise RuntimeError(f"silver has {there} rows and its batches {before}: another batch broke off; append that one again first")
    io.write_table(spark.createDataFrame([(before, new)], "before long, rows long").coalesce(1), intent)
    io.write_silver(rows, path, fmt=args.format, mode="append", clustering=args.clustering)
    return new


def stage_input(spark: SparkSession, states: Versions, run_id: str, args) -> None:
    """The one pass over the raw input: typed rows, malformed lines in a folder
    of their own, and the rows that fail each rule, counted on the way.

    In a session of its own: one that has observed something can't be part of
    a closure any more, and fitted models send theirs to the tasks."""
    rows, rejects = C.observed_rejects(C.staged(read_raw(staging_session(spark), args)))
    states.add_lines("staged", rows, run_id, [C.IS_MALFORMED])
    states.add_lines("rejects", C.reject_table(spark, rejects), run_id)


def take_in(spark: SparkSession, path: str, states: Versions, batch: str, args) -> list[str | None] | None:
    """Reads the input into silver and the states and commits. Returns the
    months that gold must be rewritten for; null: all."""
    append = args.mode == "append"
    if append and batch in states.batches:
        return None
    known = append and bool(states.batches) and states.marked("gold")
    # an overwrite is a run of its own, also under the name of an old batch
    run_id = batch if append else uuid.uuid4().hex
    if not append:
        states.batches, states.lines = {}, {}
    stage_input(spark, states, run_id, args)
    new = C.silver_of(states.read_lines("staged", run_id))
    months = months_of(new)
    if not append:
        io.write_silver(new, path, fmt=args.format, overwrite=args.overwrite, clustering=args.clustering)
        if args.overwrite == "dynamic":  # partitions of these months without new rows have stayed
            new = io.read_table(spark, path, args.format, schema=SILVER_SCHEMA).where(in_months(months))
    for name, st in ST.STATES.items():
        states.add(name, st, new, months, run_id, replace=not append)
    if append:
        rows = append_once(spark, new, path, states, batch, args)
    else:
        rows = io.read_table(spark, path, args.format, schema=SILVER_SCHEMA).count()
    states.commit(batch, rows)
    return months if known else None


def run(spark: SparkSession, args) -> dict[str, str]:
    base = args.out_base.rstrip("/")
    states = Versions(spark, f"{base}/state", fresh=args.mode == "overwrite" and args.overwrite == "static")
    batch = args.batch or uuid.uuid4().hex
    out = Tables(spark, args)
    path = args.silver or f"{base}/{SILVER}"
    if args.silver:
        s = io.read_table(spark, path, args.format, schema=SILVER_SCHEMA)
        months = months_of(s)
        for name, st in ST.STATES.items():
            states.add(name, st, s, months, batch, replace=True)
        states.commit(batch, s.count())
    else:
        out.months = take_in(spark, path, states, batch, args)
        out.written[SILVER] = path
        s = io.read_table(spark, path, args.format, schema=SILVER_SCHEMA)
    gold(out, s, states, args)
    states.mark("gold")
    if not args.silver:
        out.save("quality/rejects", C.all_rejects(states.read_lines("rejects")))
        over_raw_lines(out, states.read_lines("staged"), args)
    return out.written


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = session()
    for name, path in run(spark, args).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
