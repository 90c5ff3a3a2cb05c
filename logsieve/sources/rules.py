"""Rule sources and the rule snapshot store (SRC2-SRC6, SRC10, SRC11, SNK1, STR5).

Rules live in base tables (JDBC, parquet, ...). `sync_rules` assembles them
with Spark joins, stringifies them and writes one snapshot table per rule
name under a shared folder; the log job reads the snapshots. Connection
options always come from the caller.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..operators import assembly as asm
from ..storage import FolderLog

# --- fixed values: snapshot names and the bundle keys they load under ---
SNAPSHOT_LOG_RULES = "logRegex"
SNAPSHOT_USER_LOG_RULES = "logRegexByUser"
SNAPSHOT_EVENT_DEFS_SYSTEM = "eventDefBySystem"
SNAPSHOT_EVENT_DEFS_USER = "eventDefByUser"
SNAPSHOT_EVENT_FIELDS = "eventRule"
BUNDLE_KEYS = {
    "logRule": SNAPSHOT_LOG_RULES,
    "logUserRule": SNAPSHOT_USER_LOG_RULES,
    "eventDefRuleByUser": SNAPSHOT_EVENT_DEFS_USER,
    "eventDefRuleBySystem": SNAPSHOT_EVENT_DEFS_SYSTEM,
    "eventFieldRule": SNAPSHOT_EVENT_FIELDS,
}
# --- end of fixed values ---

KNOWN_COLUMNS = {
    SNAPSHOT_LOG_RULES: S.LOG_RULE_COLUMNS,
    SNAPSHOT_USER_LOG_RULES: S.LOG_RULE_COLUMNS,
    SNAPSHOT_EVENT_DEFS_SYSTEM: S.EVENT_DEF_SYSTEM_COLUMNS,
    SNAPSHOT_EVENT_DEFS_USER: S.EVENT_DEF_USER_COLUMNS,
    SNAPSHOT_EVENT_FIELDS: S.EVENT_FIELD_COLUMNS,
}

# Order that fixes "first rule wins" for each snapshot.
RULE_ORDER = {
    SNAPSHOT_LOG_RULES: ["log_rule_id", "device_ip"],
    SNAPSHOT_USER_LOG_RULES: ["log_rule_id"],
    SNAPSHOT_EVENT_DEFS_SYSTEM: ["event_rule_id", "event_rule_field"],
    SNAPSHOT_EVENT_DEFS_USER: ["event_rule_id"],
    SNAPSHOT_EVENT_FIELDS: ["event_rule_field_id"],
}


@dataclass
class TableSource:
    """Where base tables come from: a format plus options, and either one
    `path_template` (e.g. "/data/rules/{name}") or JDBC `dbtable` = name."""
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    path_template: str | None = None

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        r = spark.read.format(self.fmt).options(**self.options)
        if self.fmt == "jdbc":
            return r.option("dbtable", name).load()
        return r.load(self.path_template.format(name=name) if self.path_template else name)


def read_log_rules(spark: SparkSession, src: TableSource) -> DataFrame:
    """SRC2: the log rule table assembled from its four base tables."""
    return asm.assemble_log_rules(src.read(spark, "t_siem_log_regex"), src.read(spark, "t_siem_log_regex_lib"),
                                  src.read(spark, "t_siem_moni_ne"), src.read(spark, "t_moni_device_ip"))


def read_event_defs_user(spark: SparkSession, src: TableSource) -> DataFrame:
    """SRC3."""
    return asm.event_defs_user(src.read(spark, "t_siem_event_rule_def"))


def read_event_defs_system(spark: SparkSession, src: TableSource) -> DataFrame:
    """SRC4 (J2)."""
    return asm.event_defs_system(src.read(spark, "t_siem_event_rule_def"),
                                 src.read(spark, "t_siem_event_rule_field"))


def read_event_fields(spark: SparkSession, src: TableSource) -> DataFrame:
    """SRC5."""
    return asm.event_rule_fields(src.read(spark, "t_siem_event_rule_field"))


class SnapshotStore:
    """Rule snapshots as versioned tables under one shared folder: `name/version=<n>`, and bundles of them.

    A version is published by the commit marker that Spark's writer leaves last, and
    never changed afterwards, so a reader that holds an older version keeps its files,
    and a version that is still being written is not seen. `prune` removes old ones.

    A bundle is a manifest that names one version of each table. It is published last, so a reader gets the tables of
    one sync, or those of the one before, and never some of each.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bundles = FolderLog(spark, f"{self.root}/_bundle")

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/version={version}"

    def _folder(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self, name: str, published: bool = True) -> list[int]:
        """Versions of a snapshot in order, all or only the published ones."""
        p, fs = self._folder(f"{self.root}/{name}")
        if not fs.exists(p):
            return []
        out = []
        for status in fs.listStatus(p):
            child = status.getPath()
            if child.getName().startswith("version="):
                done = fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(child, "_SUCCESS"))
                if done or not published:
                    out.append(int(child.getName().split("=")[1]))
        return sorted(out)

    def write(self, df: DataFrame, name: str, order_cols: list[str] | None = None) -> int:
        """SNK1: publish `df` as the next version of snapshot `name`, all values text
        (PRJ9), with `rule_seq` fixing the rule order. Returns the version."""
        out = asm.stringify(df.drop("rule_seq") if "rule_seq" in df.columns else df)
        order = [c for c in (order_cols or RULE_ORDER.get(name, [])) if c in out.columns] or out.columns[:1]
        version = max(self.versions(name, published=False), default=0) + 1
        asm.with_rule_seq(out, order).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true") \
            .parquet(self.path(name, version))
        return version

    def read(self, name: str, required: bool = False) -> DataFrame:
        """SRC6: the latest published version of snapshot `name`. One that was never published is an
        empty table of the known columns, or an error where it is required."""
        versions = self.versions(name)
        if versions:
            return self.spark.read.parquet(self.path(name, versions[-1]))
        if required:
            raise FileNotFoundError(f"no published snapshot {name} under {self.root}")
        cols = KNOWN_COLUMNS.get(name, ["value"])
        ddl = ", ".join(f"`{c}` string" for c in cols) + ", rule_seq bigint"
        return self.spark.createDataFrame([], ddl)

    def prune(self, name: str, keep: int = 10) -> None:
        """Remove all but the last `keep` published versions."""
        for version in self.versions(name)[:-keep]:
            p, fs = self._folder(self.path(name, version))
            fs.delete(p, True)

    def write_bundle(self, tables: dict[str, DataFrame], keep: int = 10) -> dict[str, int]:
        """SNK1 for some tables at once: all are written, then published together. Tables not given stay as they were."""
        written = {name: self.write(df, name) for name, df in tables.items()}
        self.bundles.commit({name: {"path": self.path(name, v), "version": v} for name, v in written.items()})
        for name in written:
            self.prune(name, keep)
        self.bundles.vacuum_list(keep)
        return written

    def load_bundle(self, keys: dict[str, str] | None = None) -> dict[str, DataFrame]:
        """SRC10/SRC11: the rule bundle, bundle key -> DataFrame: the versions that the latest manifest names (where
        none names a table, its latest version)."""
        named = self.bundles.current()
        return {k: self.spark.read.parquet(named[n]["path"]) if n in named else self.read(n)
                for k, n in (keys or BUNDLE_KEYS).items()}


def read_json_array_snapshot(spark: SparkSession, text_df: DataFrame, columns: list[str],
                             text_col: str = "value") -> DataFrame:
    """SRC6, legacy text form: a JSON array of string-valued objects per row
    -> one row per object, its array position as `rule_seq`."""
    schema = "array<struct<" + ",".join(f"`{c}`:string" for c in columns) + ">>"
    ex = text_df.select(F.posexplode(F.from_json(F.col(text_col), schema)).alias("rule_seq", "r"))
    return ex.select(*[F.coalesce(F.col(f"r.{c}"), F.lit("")).alias(c) for c in columns],
                     F.col("rule_seq").cast("bigint"))


def sync_rules(spark: SparkSession, src: TableSource, store: SnapshotStore) -> dict[str, int]:
    """STR5: rebuild every snapshot from the base tables (events first, then
    log rules, as the original sync did) and publish them as one bundle. Returns the row count of each."""
    built = {
        SNAPSHOT_EVENT_DEFS_SYSTEM: read_event_defs_system(spark, src),
        SNAPSHOT_EVENT_FIELDS: read_event_fields(spark, src),
        SNAPSHOT_LOG_RULES: read_log_rules(spark, src),
    }
    versions = store.write_bundle(built)
    return {name: spark.read.parquet(store.path(name, v)).count() for name, v in versions.items()}


def rule_set_counts(bundle: dict[str, DataFrame]) -> DataFrame:
    """AGG2: rows of each table of a rule bundle."""
    out = None
    for name, df in bundle.items():
        n = df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("rule_set"), "n")
        out = n if out is None else out.unionByName(n)
    return out
