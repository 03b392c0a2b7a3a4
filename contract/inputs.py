"""The given tables seen as facts, dimensions, sheets, runs and files.

Every input reads its tables whole; the oracle module states the same in SQL.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.plans import book
from cellstar.session import written_once

AS_OF = datetime(2024, 1, 31)


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- star schema -----------------------------------------------------------

    @property
    def facts(self) -> DataFrame:
        """Supplier as indicator, fiscal year starting in July as period."""
        shipped = F.col("l_shipdate")
        year = F.year(shipped) - F.when(F.month(shipped) < 7, 1).otherwise(0)
        return self.table("lineitem").select(
            _fact_id().alias("fact_id"),
            F.col("l_suppkey").alias("indicator_id"),
            year.cast("int").alias("date_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
            F.lit(None).cast("string").alias("units"),
            F.lit(None).cast("string").alias("notes"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
        )

    @property
    def fact_sums(self) -> DataFrame:
        """What loads store of the facts, each line number being a file: a table of its own."""
        facts = self.facts.withColumn("source_file", F.col("l_linenumber").cast("string"))
        sums = book.fact_states(facts, "source_file", "indicator_id", "date_id")
        return written_once(f"sums-{hashlib.md5(self.folder.encode()).hexdigest()}", sums)

    @property
    def indicators(self) -> DataFrame:
        nation = self.table("nation")
        supplier = self.table("supplier")
        return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
            F.col("s_suppkey").alias("indicator_id"),
            F.replace(F.lower("s_name"), F.lit(" "), F.lit("_")).alias("indicator_key"),
            F.col("s_name").alias("indicator_name"),
            F.col("n_name").alias("category"),
        )

    @property
    def dates(self) -> DataFrame:
        """The periods as a load leaves them: a table of its own, whose size Spark knows."""
        year = F.col("date_id")
        periods = self.facts.select("date_id").distinct().select(
            "date_id", year.alias("year"), _fiscal(year).alias("period_label"),
            F.make_date(year, F.lit(7), F.lit(1)).alias("date_value"),
        )
        return written_once(f"dates-{hashlib.md5(self.folder.encode()).hexdigest()}", periods.coalesce(1))

    @property
    def indicators_with_planned(self) -> DataFrame:
        """Also one planned indicator per nation, which has no fact."""
        nation, region = self.table("nation"), self.table("region")
        name = F.concat(F.lit("Planned "), F.col("n_name"))
        planned = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            (-1 - F.col("n_nationkey")).cast("bigint").alias("indicator_id"),
            F.replace(F.lower(name), F.lit(" "), F.lit("_")).alias("indicator_key"),
            name.alias("indicator_name"),
            F.col("r_name").alias("category"),
        )
        return self.indicators.unionByName(planned)

    @property
    def indicators_in_credit(self) -> DataFrame:
        """Only suppliers that owe nothing: the facts of the others are orphans."""
        credit = self.table("supplier").where(F.col("s_acctbal") >= 0).select(
            F.col("s_suppkey").alias("indicator_id")
        )
        return self.indicators.join(credit, "indicator_id", "left_semi")

    @property
    def locations(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("location_id"),
            F.col("n_name").alias("location_name"),
            F.col("n_name").alias("district"),
            F.col("r_name").alias("region"),
        )

    @property
    def long(self) -> DataFrame:
        """The facts as the long table a load starts from."""
        return (
            self.facts.join(self.indicators.select("indicator_id", "indicator_name"), "indicator_id")
            .join(self.dates.select("date_id", "period_label"), "date_id")
            .select(
                F.col("indicator_name").alias("indicator"),
                F.col("period_label").alias("year_label"),
                F.col("value").cast("double").alias("value"),
            )
        )

    # -- other measures --------------------------------------------------------

    @property
    def signed(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("indicator_id"),
            F.col("c_name").alias("indicator"),
            F.col("c_mktsegment").alias("category"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("value"),
        )

    @property
    def nullable(self) -> DataFrame:
        """Document text as indicator; unlabelled documents have no value."""
        documents, labels = self.table("documents"), self.table("labels")
        return documents.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
            "doc_id", "lang", F.col("text").alias("indicator"), F.col("quality").alias("value")
        )

    @property
    def measures(self) -> DataFrame:
        return self.table("events").select(
            "event_id", F.col("event_type").alias("indicator"), "ts", "value"
        )

    @property
    def unbounded_measures(self) -> DataFrame:
        broken = F.col("event_type") == "error"
        return self.table("events").select(
            "event_id", F.when(broken, F.lit(float("inf"))).otherwise(F.col("value")).alias("value")
        )

    @property
    def labels(self) -> DataFrame:
        """Period labels as people write them: fiscal, plain, dashed, padded, blank, missing."""
        year = F.year("l_shipdate") + 14
        fiscal, line, flag = _fiscal(year), F.col("l_linenumber"), F.col("l_returnflag")
        label = (
            F.when(line <= 3, fiscal)
            .when(line == 4, year.cast("string"))
            .when(line == 5, F.replace(fiscal, F.lit("/"), F.lit("-")))
            .when(line == 6, F.concat(F.lit("  "), fiscal, F.lit(" ")))
            .when(flag == "A", "n/a")
            .when(flag == "N", "")
        )
        return self.table("lineitem").select(label.alias("year_label"))

    @property
    def numbers(self) -> DataFrame:
        """Cell texts: grouped, padded, signed, scientific, text, missing; and a date column."""
        line = F.col("l_linenumber")
        quantity = F.col("l_quantity").cast("int").cast("string")
        text = (
            F.when(line == 1, F.format_number("l_extendedprice", 2))
            .when(line == 2, F.concat(F.lit(" "), quantity, F.lit("\t")))
            .when(line == 3, F.concat(quantity, F.lit("e3")))
            .when(line == 4, F.concat(F.lit("-"), F.col("l_partkey").cast("string")))
            .when(line == 5, F.concat(F.lit("."), F.col("l_suppkey").cast("string")))
            .when((line == 6) & (F.col("l_linestatus") == "F"), F.concat(quantity, F.lit("d")))
            .when(line == 6, F.concat(quantity, F.lit("_000")))
            .when(F.col("l_linestatus") == "F", F.col("l_returnflag"))
        )
        return self.table("lineitem").select(
            text.alias("text"),
            F.col("l_shipdate").cast("date").cast("string").alias("shipped"),
            quantity.alias("quantity"),
        )

    @property
    def names(self) -> DataFrame:
        """Indicator names with case, underscore, padding and length variants, also blank ones."""
        part = self.table("part").select(F.col("p_name").alias("n"))
        variants = [
            part.select("n"),
            part.select(F.upper("n")),
            part.select(F.replace("n", F.lit(" "), F.lit("_"))),
            part.select(F.concat(F.lit("  "), F.col("n"), F.lit(" "))),
            self.table("supplier").select("s_name"),
            self.table("customer").select("c_name"),
            self.table("region").select(F.lit(" ")),
            self.table("documents").select("text"),
        ]
        first, *rest = variants
        for other in rest:
            first = first.union(other)
        return first.toDF("indicator")

    @property
    def known_indicators(self) -> DataFrame:
        """A dimension that already holds the suppliers' names."""
        name = F.col("s_name")
        return self.table("supplier").select(
            (F.col("s_suppkey") + 1).alias("indicator_id"),
            F.replace(F.lower(name), F.lit(" "), F.lit("_")).alias("indicator_key"),
            name.alias("indicator_name"),
            F.lit(None).cast("string").alias("category"),
        )

    # -- sheets ----------------------------------------------------------------

    @property
    def grid(self) -> DataFrame:
        """The sheets as an ingestion leaves them: written, then read by every later step."""
        name = f"grid-{hashlib.md5(self.folder.encode()).hexdigest()}"
        return written_once(name, self.sheets)

    @property
    def sheets(self) -> DataFrame:
        """One workbook per region, one sheet per nation, and a sheet without data.

        Row 0 is a title, row 1 the header: ``Indicator``, an empty ``Notes`` column, the
        periods, the last period once more (with counts), a column without a name. A
        supplier has one row per line number and an empty row before them.
        """
        supplier, nation, region = self.table("supplier"), self.table("nation"), self.table("region")
        owners = (
            supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(
                F.concat(F.col("r_name"), F.lit(".xlsx")).alias("source_file"),
                F.col("n_name").alias("sheet"),
                F.col("s_suppkey").alias("indicator_id"),
                "s_name",
                "s_acctbal",
            )
        )
        periods = self.dates.agg(F.array_sort(F.collect_list("period_label")).alias("p"))
        labels = periods.select("p").scalar()
        last = F.element_at(labels, -1)

        sums = self.facts.groupBy("indicator_id", "l_linenumber", "date_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
        )
        text = F.when(F.col("n") <= 3, "n.a.").otherwise(F.format_number("total", 2))
        period = _fiscal(F.col("date_id"))
        rows = (
            sums.groupBy("indicator_id", "l_linenumber")
            # At most one entry per period.
            .agg(
                F.map_from_entries(F.collect_list(F.struct(period, text))).alias("by_period"),
                F.max(F.when(period == last, F.col("n").cast("string"))).alias("again"),
            )
            .join(owners, "indicator_id")
            .withColumn("labels", labels)
        )
        data = rows.select(
            "source_file",
            "sheet",
            (F.col("indicator_id") * 8 + F.col("l_linenumber") + 2).alias("row_idx"),
            F.concat(
                F.array(F.concat(F.lit(" "), F.col("s_name")), F.lit(None).cast("string")),
                F.transform("labels", lambda p: F.try_element_at("by_period", p)),
                F.array(F.col("again"), F.col("s_acctbal").cast("string")),
            ).alias("cells"),
        )
        width = F.size(labels) + 4
        spacers = owners.select(
            "source_file", "sheet", (F.col("indicator_id") * 8 + 2).alias("row_idx"),
            F.array_repeat(F.lit(None).cast("string"), width).alias("cells"),
        )
        tops = owners.select("source_file", "sheet").distinct()
        titles = tops.select(
            "source_file", "sheet", F.lit(0).cast("bigint").alias("row_idx"),
            F.array(F.concat(F.lit("Annual table of "), F.col("sheet"))).alias("cells"),
        )
        headers = tops.select(
            "source_file", "sheet", F.lit(1).cast("bigint").alias("row_idx"),
            F.concat(
                F.array(F.lit("Indicator"), F.lit(" Notes")), labels, F.array(last, F.lit(" "))
            ).alias("cells"),
        )
        about = region.select(
            F.concat(F.col("r_name"), F.lit(".xlsx")).alias("source_file"), F.lit("About").alias("sheet"),
            F.lit(0).cast("bigint").alias("row_idx"),
            F.array(F.concat(F.lit("Tables of "), F.col("r_name")), F.lit("1/2")).alias("cells"),
        )
        return data.unionByName(spacers).unionByName(titles).unionByName(headers).unionByName(about)

    # -- metadata --------------------------------------------------------------

    @property
    def runs(self) -> DataFrame:
        event, kind = F.col("event_id"), F.col("event_type")
        running = event % 50 == 0
        done = F.timestamp_add("MILLISECOND", F.round(F.col("value") * 1000).cast("int"), F.col("ts"))
        return self.table("events").select(
            event.alias("run_id"),
            F.concat(F.lit("pipeline_"), (F.col("user_id") % 5).cast("string")).alias("pipeline_name"),
            F.when(kind == "view", "ingestion").when(kind == "click", "transform").otherwise("load").alias(
                "pipeline_stage"
            ),
            _source(F.col("user_id")).alias("source_file"),
            F.col("ts").alias("started_at"),
            F.when(~running, done).alias("completed_at"),
            F.when(running, "running")
            .when(kind == "error", "failed")
            .when(kind == "signup", "skipped")
            .otherwise("success")
            .alias("status"),
            (event % 1000).alias("records_processed"),
            (event % 1000 - event % 7).alias("records_loaded"),
            F.when(~running, F.col("value")).alias("execution_duration_seconds"),
            F.when(kind == "error", F.concat(F.lit("failed on "), F.col("props"))).alias("error_message"),
        )

    @property
    def run_events(self) -> DataFrame:
        """Log of those runs; leaving the run's scope logs a second, implicit success."""
        runs = self.runs
        done = runs.where(F.col("completed_at").isNotNull())
        origin = ["pipeline_name", "pipeline_stage", "source_file"]
        later = ["status", "records_processed", "records_loaded", "error_message"]
        start = runs.select(
            "run_id", F.lit("start").alias("event"), F.col("started_at").alias("event_ts"), *origin,
            F.lit("running").alias("status"),
            F.lit(None).cast("bigint").alias("records_processed"),
            F.lit(None).cast("bigint").alias("records_loaded"),
            F.lit(None).cast("string").alias("error_message"),
        )
        explicit = done.select(
            "run_id", F.lit("complete").alias("event"), F.col("completed_at").alias("event_ts"), *origin, *later
        )
        implicit = explicit.select(
            "run_id",
            "event",
            (F.col("event_ts") + F.expr("INTERVAL 1 DAY")).alias("event_ts"),
            *origin,
            F.lit("success").alias("status"),
            *[F.lit(None).cast(explicit.schema[c].dataType).alias(c) for c in later if c != "status"],
        )
        return start.unionByName(explicit).unionByName(implicit)

    @property
    def metrics(self) -> DataFrame:
        event = F.col("event_id")
        return self.table("events").select(
            event.alias("metric_id"),
            (event % 997).alias("run_id"),
            F.concat(F.lit("check_"), (event % 7).cast("string")).alias("check_name"),
            F.when(event % 4 == 0, "completeness")
            .when(event % 4 == 1, "validity")
            .when(event % 4 == 2, "consistency")
            .otherwise("timeliness")
            .alias("check_category"),
            F.concat(F.lit("table_"), (event % 3).cast("string")).alias("table_name"),
            F.lit(None).cast("string").alias("column_name"),
            (F.col("value") < 100).alias("passed"),
            F.col("value").alias("metric_value"),
            F.lit(100.0).alias("threshold_value"),
            F.col("props").alias("details"),
            F.col("ts").alias("checked_at"),
        )

    @property
    def lineage(self) -> DataFrame:
        event, kind = F.col("event_id"), F.col("event_type")
        return self.table("events").select(
            (event % 997).alias("run_id"),
            F.concat(F.lit("table_"), (event % 3).cast("string")).alias("target_table"),
            F.concat(F.lit("col_"), (event % 5).cast("string")).alias("target_column"),
            _source(F.col("user_id")).alias("source_file"),
            F.concat(F.lit("sheet_"), (event % 2).cast("string")).alias("source_sheet"),
            kind.alias("source_column"),
            F.concat(F.lit("rule "), kind).alias("transformation_logic"),
            F.when(event % 4 == 0, "direct_copy")
            .when(event % 4 == 1, "unpivot")
            .when(event % 4 == 2, "aggregate")
            .otherwise("derived")
            .alias("transformation_type"),
            F.col("ts").alias("recorded_at"),
        )

    @property
    def files_now(self) -> DataFrame:
        return self.table("pages").select(
            _page().alias("file_path"),
            F.md5("html").alias("file_hash"),
            F.length("html").cast("bigint").alias("n_chars"),
        )

    @property
    def files_registry(self) -> DataFrame:
        """Pages served over a secure address are known; those with a query were different."""
        url = F.col("url")
        stale = F.contains(url, F.lit("?"))
        return (
            self.table("pages")
            .where(F.startswith(url, F.lit("https")))
            .select(
                _page().alias("file_path"),
                F.when(stale, F.md5(F.concat("html", F.lit("x")))).otherwise(F.md5("html")).alias("file_hash"),
                (1 + F.col("page_id") % 4).alias("processing_count"),
                F.when(
                    ~stale, F.timestamp_add("SECOND", F.col("page_id").cast("int"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
                ).alias("last_processed"),
            )
        )


def _fact_id() -> Column:
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")


def _fiscal(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("/"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))


def _source(user: Column) -> Column:
    return F.concat(F.lit("src_"), (user % 20).cast("string"), F.lit(".xlsx"))


def _page() -> Column:
    return F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html"))
