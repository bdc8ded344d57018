"""Run settings: thresholds, naming rules, clock and execution limits."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import SparkSession

from vaultgauge import rules


@dataclass(frozen=True)
class Settings:
    # Labels of the report.
    database: str = "vault"
    report_title: str | None = None
    schema_label: str = ""
    mart_name: str = ""

    # Thresholds.
    stale_hours: int = rules.STALE_HOURS
    spike_multiplier: int = rules.SPIKE_MULTIPLIER
    spike_window_days: int = rules.SPIKE_WINDOW_DAYS
    single_source_percent: int = rules.SINGLE_SOURCE_PERCENT

    # "Now" for every check of a run, in the session time zone. None reads the clock once per run.
    as_of: str | datetime | None = None

    # Naming conventions.
    prefixes: dict = field(default_factory=lambda: rules.PREFIXES)
    synonyms: dict = field(default_factory=lambda: rules.SYNONYMS)
    fuzzy_rules: dict = field(default_factory=lambda: rules.FUZZY_RULES)
    # True: only a table that holds its conventional key may be a parent.
    strict_parents: bool = False
    # True: text load times that are no timestamps count as NULL. False: they make the check an ERROR.
    # None follows spark.sql.ansi.enabled.
    lenient_timestamps: bool | None = None

    # Execution.
    concurrent_passes: int = 8
    # Keys of a parent or child are broadcast only when their measured size stays below this many bytes.
    broadcast_key_bytes: int = 64 * 1024 * 1024
    # Children that share one shuffle with their parent; more children take another round.
    children_per_round: int = 8
    # Tables bucketed by their keys are joined and grouped bucket by bucket, without a shuffle. Not where one bucket's files are
    # larger than this many bytes and than so many times the average: it would be a single task.
    use_buckets: bool = True
    hot_bucket_bytes: int = 1024 * 1024 * 1024
    hot_bucket_factor: float = 3.0
    # A folder for partial results per file: a later run reads new and changed files only, where a table is a plain scan of files.
    # Shared by driver and executors; None: every run reads all rows. Pays unless nearly every row has a source of its own.
    partials_folder: str | None = None
    # Seconds after which a pass is stopped, and its checks are errors; None: never.
    pass_seconds: float | None = None
    # Duplicate checks of one table share a scan and a shuffle (grouping sets). The values are the same.
    share_grains: bool = True
    # Duplicates: group 64-bit hashes first and full keys only where hashes repeat. Pays where keys are wide and duplicates
    # rare; needs spark.checkpoint.dir. The values are the same, and where it fails the plain grouping answers.
    hash_first: bool = False

    def resolved(self, spark: SparkSession) -> Settings:
        """The same settings with clock and cast mode fixed for one run."""
        if self.as_of is None:
            instant = "current_timestamp()"
        elif isinstance(self.as_of, datetime) and self.as_of.tzinfo is not None:
            instant = f"timestamp_micros({round(self.as_of.timestamp() * 1_000_000)})"
        else:
            instant = f"CAST('{self.as_of}' AS TIMESTAMP)"
        as_of = spark.sql(f"SELECT CAST({instant} AS STRING)").first()[0]
        lenient = self.lenient_timestamps
        if lenient is None:
            lenient = spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true"
        return replace(self, as_of=as_of, lenient_timestamps=lenient)

    @property
    def now(self) -> str:
        """The clock of resolved settings as a SQL literal."""
        return f"TIMESTAMP '{self.as_of}'"

    @property
    def today(self) -> str:
        return f"DATE '{self.as_of[:10]}'"

    @property
    def title(self) -> str:
        return (self.report_title or self.database).upper()
