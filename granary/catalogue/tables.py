"""The model's tables, derived from a star schema with events and documents.

Each function maps given tables to one table of the model; nothing is made up
beyond renaming, labelling and simple arithmetic, so the work grows with the
data.  Time columns keep their stored type, which lets range filters reach the
parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

SCOPE_CHUNK = 500


class Tables:
    """Model tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def raw(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once."""
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            df = self.spark.read.parquet(path)
            self._schemas[name] = df.schema
            return df
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    # -- usage ---------------------------------------------------------------

    def download_events(self) -> DataFrame:
        """One row per line item: its supplier is the project, its customer the user."""
        lines = self.raw("lineitem").select(
            "l_orderkey",
            F.col("l_suppkey").alias("project_id"),
            F.col("l_partkey").alias("file_handle_id"),
            F.col("l_shipdate").alias("record_date"),
            F.when(F.col("l_linestatus") == "F", "prod").otherwise("dev").alias("stack"),
        )
        users = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")
        )
        return lines.join(users, "l_orderkey").drop("l_orderkey")

    def files(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            F.round(F.col("p_retailprice") * 100).cast("long").alias("content_size"),
            F.when(F.col("p_size") > 10, F.lower("p_type")).alias("content_type"),
        )

    def project_nodes(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_suppkey").alias("project_id"),
            F.col("s_name").alias("name"),
            F.lit("project").alias("node_type"),
            (F.col("s_acctbal") > 0).alias("is_public"),
        )

    def file_nodes(self) -> DataFrame:
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_suppkey").alias("project_id"),
            F.lit("file").alias("node_type"),
            F.lit(True).alias("is_public"),
            F.col("l_partkey").alias("file_handle_id"),
            F.col("l_shipdate").alias("created_on"),
        )

    def view_nodes(self) -> DataFrame:
        """One view per region whose scope is the region's suppliers.

        Scopes are kept in chunks, so no array grows with the data.
        """
        nation = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
        members = self.raw("supplier").select("s_suppkey", "s_nationkey").join(nation, "s_nationkey")
        chunks = members.groupBy(
            "n_regionkey", F.floor(F.col("s_suppkey") / SCOPE_CHUNK).alias("chunk")
        ).agg(F.collect_list("s_suppkey").alias("scope_ids"))
        return chunks.select(
            (F.col("n_regionkey") - 100).cast("long").alias("id"),
            F.lit("entityview").alias("node_type"),
            F.lit(False).alias("is_public"),
            "scope_ids",
        )

    def nodes(self) -> DataFrame:
        """Projects, files and views in one table; a filter on the type drops the other branches."""
        parts = [self.project_nodes(), self.file_nodes(), self.view_nodes()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def associations(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_partkey").alias("filehandleid"),
            F.when(F.col("l_returnflag") == "R", "TableEntity").otherwise("FileEntity").alias("associatetype"),
        )

    def access_events(self) -> DataFrame:
        return self.raw("events").select("user_id", F.col("ts").alias("record_date"))

    # -- entities ------------------------------------------------------------

    def profiles(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("user_name"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("first_name"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("last_name"),
        )

    def entities(self) -> DataFrame:
        """Orders as entities; the priority is kept as a list annotation."""
        annotations = F.when(
            F.col("o_orderpriority") == "1-URGENT",
            F.lit('{"annotations":{"contentType":{"type":"STRING","value":["dataset"]}}}'),
        ).when(
            F.col("o_orderpriority") == "2-HIGH",
            F.lit('{"annotations":{"contentType":{"type":"STRING","value":["dataset","table"]}}}'),
        ).otherwise(F.lit('{"annotations":{}}'))
        kind = (
            F.when(F.col("o_orderstatus") == "O", "project")
            .when(F.col("o_orderstatus") == "F", "file")
            .otherwise("folder")
        )
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("Entity "), F.col("o_orderkey").cast("string")).alias("name"),
            F.col("o_custkey").alias("project_id"),
            kind.alias("node_type"),
            F.parse_json(annotations).alias("annotations"),
            F.col("o_orderdate").alias("created_on"),
            F.col("o_custkey").alias("created_by"),
            (F.col("o_totalprice") > 200000).alias("is_public"),
        )

    # -- runs ----------------------------------------------------------------

    def runs(self) -> DataFrame:
        orders = self.raw("orders")
        owners = self.raw("customer").select(
            F.col("c_custkey").alias("o_custkey"),
            F.col("c_nationkey").alias("workspace_id"),
            F.col("c_name").alias("user_name"),
        )
        return orders.join(owners, "o_custkey").select(
            F.col("o_orderkey").alias("id"),
            "workspace_id",
            F.col("o_orderpriority").alias("project_name"),
            F.col("o_orderstatus").alias("status"),
            "user_name",
            F.col("o_orderdate").alias("date_created"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("complete"),
        )

    def workspaces(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("full_name")
        )

    def finished_runs(self) -> DataFrame:
        """Orders with their last shipping moment as completion."""
        done = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.max("l_shipdate").alias("complete")
        )
        seconds = F.col("o_orderkey") % 86400
        return self.raw("orders").join(done, "o_orderkey", "left").select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_name"),
            F.col("o_orderstatus").alias("state"),
            (F.col("o_orderstatus") == "F").alias("is_successful"),
            F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("dataset"),
            F.col("o_orderdate").alias("submit"),
            (F.col("complete") + F.make_dt_interval(secs=seconds)).alias("complete"),
        )

    def tasks(self) -> DataFrame:
        """Labelled documents as task logs; low quality means the task failed."""
        labels = self.raw("labels").select("doc_id", "quality")
        return self.raw("documents").join(labels, "doc_id").select(
            F.col("doc_id").alias("task_id"),
            F.col("source").alias("tag"),
            F.when(F.col("quality") == 0, "FAILED").otherwise("COMPLETED").alias("status"),
            F.col("text").alias("execution_log"),
        )

    # -- releases ------------------------------------------------------------

    def main_samples(self) -> DataFrame:
        """Orders as samples of quarterly releases."""
        return self.raw("orders").select(
            F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("SAMPLE_ID"),
            F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("PATIENT_ID"),
            F.year("o_orderdate").alias("MAJOR_VERSION"),
            F.quarter("o_orderdate").alias("MINOR_VERSION"),
            F.concat_ws("_", F.year("o_orderdate").cast("string"), F.quarter("o_orderdate").cast("string"), F.lit("CONSORTIUM")).alias("RELEASE"),
        )

    def cohort_samples(self) -> DataFrame:
        """Line items as samples of monthly cohort releases; the return flag is the cohort."""
        patients = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        lines = self.raw("lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")
        # a left join, which drops out where only cohort and version are wanted
        return lines.join(patients, "l_orderkey", "left").select(
            F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("PANEL_SAMPLE_ID"),
            F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("RECORD_ID"),
            F.col("l_returnflag").alias("COHORT"),
            F.year("l_shipdate").alias("MAJOR_VERSION"),
            F.month("l_shipdate").alias("MINOR_VERSION"),
            F.concat_ws("_", F.year("l_shipdate").cast("string"), F.month("l_shipdate").cast("string"), F.lit("PUBLIC")).alias("RELEASE"),
        )

    def project_samples(self, priority: str) -> DataFrame:
        return self.raw("orders").filter(F.col("o_orderpriority") == priority).select(
            F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("SAMPLE_ID"),
            F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("P"), F.col("o_custkey").cast("string"))).alias("PATIENT"),
        )

    # -- catalogue -----------------------------------------------------------

    def dataset_items(self) -> DataFrame:
        """Documents as files of the data set named by their source."""
        return self.raw("documents").select(
            F.concat(F.lit("syn"), F.regexp_extract("source", r"(\d+)$", 1)).alias("dataset_id"),
            F.lit(1).alias("dataset_version"),
            F.lit("syn900").alias("dataset_collection"),
            F.concat(F.lit("syn"), F.col("doc_id").cast("string")).alias("file_id"),
            F.when(F.col("lang") == "en", 2).otherwise(1).alias("file_version"),
        )

    def datasets(self) -> DataFrame:
        sources = self.raw("documents").select("source").distinct()
        number = F.regexp_extract("source", r"(\d+)$", 1)
        few = number.cast("int") < 10
        return sources.select(
            F.concat(F.lit("syn"), number).alias("dataset_id"),
            F.lit(1).alias("dataset_version"),
            F.lit("syn900").alias("dataset_collection"),
            F.col("source").alias("name"),
            F.when(few, F.concat(F.lit("All of "), F.col("source"))).alias("description"),
            F.lit("2024-01-30T00:00:00.000Z").alias("modified_on"),
            F.when(
                few,
                F.create_map(F.lit("license"), F.array(F.lit("CC-0")), F.lit("keywords"), F.array(F.lit("text"), F.lit("web"))),
            ).otherwise(F.create_map(F.lit("title"), F.array(F.col("source")))).alias("annotations"),
        )

    def file_entities(self) -> DataFrame:
        """Documents as file entities; very short ones are not accessible and missing here."""
        version = F.when(F.col("lang") == "en", 2).otherwise(1)
        return self.raw("documents").filter("n_chars >= 100").select(
            F.concat(F.lit("syn"), F.col("doc_id").cast("string")).alias("file_id"),
            version.alias("file_version"),
            F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name"),
            F.when(F.col("lang") == "fr", F.lit("Texte")).alias("description"),
            F.concat(
                F.lit("doc_"), F.col("doc_id").cast("string"),
                F.when(F.col("lang") == "de", ".TXT.gz").when(F.col("lang") == "es", ".unknownsuffix").otherwise(".csv"),
            ).alias("file_name"),
            F.create_map(F.lit("lang"), F.col("lang"), F.concat(F.lit("K_"), F.col("lang")), F.lit("x")).alias("annotations"),
        )

    def versioned_nodes(self) -> DataFrame:
        """Documents as nodes with a version history of two entries."""
        def entry(number: int):
            return F.struct(
                F.lit(number).alias("versionNumber"),
                F.md5(F.concat(F.lit(f"{number}:"), F.col("text")).cast("binary")).alias("contentMd5"),
                (F.col("doc_id") * 2 + number).alias("fileHandleId"),
            )

        return self.raw("documents").select(
            F.col("doc_id").alias("id"),
            (F.col("n_chars") >= 200).alias("is_public"),
            F.array(entry(1), entry(2)).alias("version_history"),
        )

    def versioned_files(self) -> DataFrame:
        """Known content types of a part of the document files."""
        docs = self.raw("documents")
        return docs.filter(F.col("lang").isin("en", "fr")).select(
            (F.col("doc_id") * 2 + F.when(F.col("lang") == "en", 2).otherwise(1)).alias("id"),
            F.when(F.col("lang") == "en", "text/plain").otherwise("NOT_SET").alias("content_type"),
        )
