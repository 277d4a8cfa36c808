"""The layer tables as parquet tables behind views.

Plain parquet tables cannot be merged into or overwritten while they are read. Each new state of a
table is therefore saved beside the old one, and a view of the table's name is pointed at it when it
is complete. The state before is kept for readers that are still on it. One writer per table at a time.

Tables that grow with the sales are kept in one of two ways. In buckets of their key, a state is a
table of its own. In parts (``parts="day"``, ``"month"`` or ``"year"`` of sale), a state is a table whose
partitions lie where they were last written: a load writes the parts it touches to a new table of files,
and the new state takes these partitions from there and all others from where the state before has
them. Files of parts that no kept state has are dropped. With a number of buckets as well, every part is
kept in buckets of the key: a load then moves its delivery only, and no row of a table that it reads.

In parts, every row has the number of the load that last wrote it, so that the layer above can read what
has changed since a load it knows.

Within ``staged``, new states wait under names of their own and are shown together at the end. A run that
failed midway and is staged again under the same name finds the states that were complete.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.schemas import TABLES, TableSpec
from martloom.session import together

# Columns of a state in parts that its view does not show: the part, and the load that wrote the row.
PART, LOAD = "_part", "_load"
_GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
_KEY, _VERSION, _BUCKETS, _PARTS, _LOAD, _STAMP, _RUN, _READ = (
    f"martloom.{x}" for x in ("key", "version", "buckets", "parts", "load", "stamp", "run", "read.")
)
# Partitions named in one statement.
_AT_ONCE = 500


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        catalog: str = "retail_dev",
        root: str | None = None,
        buckets: int | None = None,
        parts: str | None = None,
    ):
        """``root`` is the folder of the databases (default: the session's warehouse folder).

        Of ``buckets``, use at least as many as shuffle partitions, and enough that one bucket of
        the sales fits a task. With another number than before, the next load of a table
        shuffles it once. With ``parts``, tables that grow have parts of that length instead of buckets;
        the first load after a change of it writes the table anew. With both, each part has that number
        of buckets, a file each: for parts so long that a delivery touches many and changes much of them.
        """
        if parts is not None and parts not in _GRAINS:
            raise ValueError(f"parts must be day, month or year, not {parts!r}")
        self.spark = spark
        self.catalog = catalog
        self.root = root
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.parts = parts
        # Buckets of a part, 0 where the parts have none.
        self.part_buckets = buckets or 0 if parts else 0
        self._known: dict[str, dict[str, str]] = {}
        self._read: dict[str, dict[str, str]] = {}
        self._run: str | None = None
        self._waiting: set[str] = set()

    def database(self, layer: str) -> str:
        return f"{self.catalog}_{layer}"

    def name(self, spec: TableSpec) -> str:
        return f"{self.database(spec.layer)}.{spec.name}"

    def ensure_database(self, layer: str) -> None:
        place = f" LOCATION '{self.root}/{self.database(layer)}'" if self.root else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{place}")

    def exists(self, spec: TableSpec) -> bool:
        return spec.label in self._waiting or self._there(spec.layer, self.name(spec))

    def ensure(self, spec: TableSpec) -> None:
        """Create the table, empty and typed, unless it is there."""
        self.ensure_database(spec.layer)
        if not self.exists(spec):
            self.replace(spec, self.spark.createDataFrame([], spec.schema))

    def read(self, spec: TableSpec) -> DataFrame:
        return self.spark.table(self._shown(spec))

    def preview(self, spec: TableSpec, rows: int = 10, order_by: str | None = None) -> DataFrame:
        """A few rows, for a look: any, or the first in an order."""
        found = self.read(spec)
        return (found.orderBy(order_by) if order_by else found).limit(rows)

    def replace(
        self,
        spec: TableSpec,
        df: DataFrame,
        grouped: bool = False,
        marks: Mapping[str, int] | None = None,
        stamp: int | None = None,
    ) -> None:
        """Save ``df`` as the new state of the table.

        ``grouped`` says that every bucket's rows are already in one partition, as after merging
        with the bucketed table itself, so that the rows need not be shuffled again. ``marks`` are kept
        for ``mark``; rows without a time in the table's stamp column show ``stamp``, in microseconds.
        """
        if self.in_parts(spec):
            self._save_parts(spec, df, {}, marks, stamp, grouped)
            return
        self.ensure_database(spec.layer)
        version = self._new_version(spec)
        if spec.grows and not grouped:
            df = df.repartition(self.buckets, spec.key)
        writer = df.write.format("parquet")
        if spec.grows:
            writer = writer.bucketBy(self.buckets, spec.key).sortBy(spec.key)
        writer.saveAsTable(f"{self.database(spec.layer)}.{version}")
        self._show(spec, {_VERSION: version, _BUCKETS: str(self.buckets if spec.grows else 0)})

    def publish_view(self, layer: str, name: str, sql: str) -> None:
        self.ensure_database(layer)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database(layer)}.{name} AS {sql}")

    def has_buckets(self, spec: TableSpec, buckets: int) -> bool:
        """Whether the table is there and kept in this number of buckets."""
        return self._properties(spec).get(_BUCKETS) == str(buckets)

    # Tables in parts.

    def in_parts(self, spec: TableSpec) -> bool:
        """Whether the table is to be kept in parts."""
        return spec.grows and self.parts is not None

    def has_parts(self, spec: TableSpec) -> bool:
        """Whether the table is there and kept in parts of the right length and number of buckets."""
        kept = self._properties(spec) if self.in_parts(spec) else {}
        return kept.get(_PARTS) == self.parts is not None and kept.get(_BUCKETS) == str(self.part_buckets)

    def part_of(self, spec: TableSpec) -> Column:
        return F.coalesce(F.date_format(spec.day, _GRAINS[self.parts]), F.lit("none"))

    def rows(self, spec: TableSpec) -> DataFrame:
        """The rows as they are kept, with their part and load. In a table that is not in parts yet, load 0."""
        if self.has_parts(spec):
            return self.spark.table(f"{self.database(spec.layer)}.{self._properties(spec)[_VERSION]}")
        return self.read(spec).withColumns({LOAD: F.lit(0).cast("long"), PART: self.part_of(spec)})

    def load(self, spec: TableSpec) -> int:
        """The number of the last load, 0 before the first one in parts."""
        return int(self._properties(spec).get(_LOAD, 0)) if self.has_parts(spec) else 0

    def mark(self, spec: TableSpec, name: str) -> int:
        """What the last load of the table noted under a name, -1 if nothing."""
        return int(self._properties(spec).get(_READ + name, -1)) if self.has_parts(spec) else -1

    def stamp(self, spec: TableSpec) -> int | None:
        """The time shown for rows that have none of their own, in microseconds."""
        found = self._properties(spec).get(_STAMP)
        return None if found is None else int(found)

    def replace_parts(
        self,
        spec: TableSpec,
        df: DataFrame,
        parts: Sequence[str],
        marks: Mapping[str, int] | None = None,
        stamp: int | None = None,
        grouped: bool = False,
    ) -> None:
        """Save ``df`` in place of these parts, and keep all others where they are; ``grouped`` as in ``replace``."""
        if not self.has_parts(spec):
            raise ValueError(f"{spec.label} is not kept in parts of a {self.parts}")
        state = f"{self.database(spec.layer)}.{self._properties(spec)[_VERSION]}"
        kept = {part: place for part, place in self._places(state).items() if part not in set(parts)}
        self._save_parts(spec, df, kept, marks, stamp, grouped)

    def put_down(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        """Rows that are to be merged into a table whose parts have buckets, written once in such buckets.

        They are dropped with the states that the merge leaves behind.
        """
        self.ensure_database(spec.layer)
        name = f"{self.database(spec.layer)}.{self._new_version(spec)}_came"
        writer = df.repartition(self.part_buckets, spec.key).write.format("parquet").option("compression", "zstd")
        writer.bucketBy(self.part_buckets, spec.key).saveAsTable(name)
        return self.spark.table(name)

    def _save_parts(
        self,
        spec: TableSpec,
        df: DataFrame,
        kept: Mapping[str, str],
        marks: Mapping[str, int] | None,
        stamp: int | None,
        grouped: bool = False,
    ) -> None:
        self.ensure_database(spec.layer)
        load = self.load(spec) + 1
        database, version = self.database(spec.layer), self._new_version(spec)
        if LOAD not in df.columns:
            df = df.withColumn(LOAD, F.lit(load).cast("long"))
        dealt, clustered = df.select(*spec.columns, LOAD, self.part_of(spec).alias(PART)), ""
        if self.part_buckets:
            # Rows that Spark knows to be grouped by key in this number are not moved by the repartition.
            dealt = dealt if grouped else dealt.repartition(self.part_buckets, spec.key)
            writer = dealt.write.bucketBy(self.part_buckets, spec.key).option("compression", "zstd")
            clustered = f"CLUSTERED BY ({spec.key}) INTO {self.part_buckets} BUCKETS "
        else:
            # Spark deals the rows out again by part: small parts share a task, large ones have several.
            writer = dealt.hint("rebalance", PART).write
        files = f"{database}.{version}_files"
        writer.format("parquet").partitionBy(PART).saveAsTable(files)
        placed = dict(kept) | self._places(files)
        places = sorted(placed.items())
        self.spark.sql(
            f"CREATE TABLE {database}.{version} ({spec.ddl}, {LOAD} BIGINT, {PART} STRING) USING parquet "
            f"PARTITIONED BY ({PART}) {clustered}LOCATION '{self._folder(spec.layer)}/{version}'"
        )
        for at in range(0, len(places), _AT_ONCE):
            named = " ".join(f"PARTITION ({PART} = '{part}') LOCATION '{place}'" for part, place in places[at : at + _AT_ONCE])
            self.spark.sql(f"ALTER TABLE {database}.{version} ADD {named}")
        self._known[f"{database}.{version}"] = placed
        properties = {_VERSION: version, _BUCKETS: str(self.part_buckets), _PARTS: self.parts, _LOAD: str(load)}
        properties |= {_READ + name: str(value) for name, value in (marks or {}).items()}
        self._show(spec, properties | ({} if stamp is None else {_STAMP: str(stamp)}))

    def _places(self, table: str) -> dict[str, str]:
        """The folder of each part; a state never changes."""
        if table not in self._known:
            folders = {unquote(f).rsplit("/", 1)[0] for f in self.spark.table(table).inputFiles()}
            self._known[table] = {folder.rsplit(f"{PART}=", 1)[1]: folder for folder in folders}
        return self._known[table]

    def _folder(self, layer: str) -> str:
        return self.spark.catalog.getDatabase(self.database(layer)).locationUri

    # Runs whose new states are shown together.

    @contextmanager
    def staged(self, run: str) -> Iterator[None]:
        """Within, ``replace`` does not show new states to others; they are shown when the block ends well.

        After an error they wait: ``staged`` under the same name finds them (``waits``), under another one
        drops them.
        """
        found = together(lambda spec: self._is_of(spec, run), TABLES)
        self._waiting = {spec.label for spec in TABLES if found[spec]}
        self._run = run
        try:
            yield
            waiting = [spec for spec in TABLES if spec.label in self._waiting]
            before = {spec: self._properties_of(self.name(spec), spec.layer).get(_VERSION) for spec in waiting}
            now = {spec: self._properties(spec) for spec in waiting}
            together(lambda spec: self._define(self.name(spec), spec, now[spec]), waiting)
        finally:
            self._run, self._waiting, self._read = None, set(), {}

        def tidy(spec: TableSpec) -> None:
            self.spark.sql(f"DROP VIEW IF EXISTS {self._waiting_name(spec)}")
            self._drop_all_but(spec, {before[spec], now[spec][_VERSION]})

        together(tidy, waiting)

    def waits(self, spec: TableSpec) -> bool:
        """Whether this run has already made the table's new state."""
        return spec.label in self._waiting

    def _is_of(self, spec: TableSpec, run: str) -> bool:
        name = self._waiting_name(spec)
        if not self._there(spec.layer, name):
            return False
        if self._properties_of(name, spec.layer).get(_RUN) == run:
            return True
        self.spark.sql(f"DROP VIEW {name}")
        return False

    def _waiting_name(self, spec: TableSpec) -> str:
        return f"{self.name(spec)}_next"

    def _shown(self, spec: TableSpec) -> str:
        return self._waiting_name(spec) if spec.label in self._waiting else self.name(spec)

    def _show(self, spec: TableSpec, properties: Mapping[str, str]) -> None:
        if self._run is not None:
            self._define(self._waiting_name(spec), spec, {**properties, _RUN: self._run})
            self._waiting.add(spec.label)
            return
        current = self._properties(spec).get(_VERSION)
        self._define(self.name(spec), spec, properties)
        self._drop_all_but(spec, {properties[_VERSION], current})

    def _define(self, name: str, spec: TableSpec, properties: Mapping[str, str]) -> None:
        named = ", ".join(f"'{k}' = '{v}'" for k, v in {**properties, _KEY: spec.key}.items())
        columns = "*"
        if _PARTS in properties:
            stamped = f"COALESCE({spec.stamp}, timestamp_micros({properties.get(_STAMP)})) AS {spec.stamp}"
            columns = ", ".join(stamped if c == spec.stamp and _STAMP in properties else c for c in spec.columns)
        version = f"{self.database(spec.layer)}.{properties[_VERSION]}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({named}) AS SELECT {columns} FROM {version}")
        self._read.pop(name, None)

    # The catalog.

    def _new_version(self, spec: TableSpec) -> str:
        return f"{spec.name}__{time.time_ns()}_{uuid.uuid4().hex[:8]}"

    def _there(self, layer: str, name: str) -> bool:
        return self.spark.catalog.databaseExists(self.database(layer)) and self.spark.catalog.tableExists(name)

    def _properties(self, spec: TableSpec) -> dict[str, str]:
        return self._properties_of(self._shown(spec), spec.layer)

    def _properties_of(self, name: str, layer: str) -> dict[str, str]:
        if self._run is not None and name in self._read:  # within a run nobody else writes the tables
            return self._read[name]
        if not self._there(layer, name):
            return {}
        read = {p.key: p.value for p in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if p.key.startswith("martloom.")}
        if self._run is not None:
            self._read[name] = read
        return read

    def _drop_all_but(self, spec: TableSpec, kept: set[str | None]) -> None:
        database = self.database(spec.layer)
        names = [r.tableName for r in self.spark.sql(f"SHOW TABLES IN {database} LIKE '{spec.name}__*'").collect()]
        files = [name for name in names if name.endswith("_files")]
        used: dict[str, set[str]] = {}
        for state in kept if files else ():
            if f"{state}_files" in files:  # a state in parts
                for part, place in self._places(f"{database}.{state}").items():
                    used.setdefault(place.rsplit("/", 2)[1], set()).add(part)
        for name in names:
            if name not in used and name not in kept:
                self.spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            elif name in used:
                there = [r.partition.removeprefix(f"{PART}=") for r in self.spark.sql(f"SHOW PARTITIONS {database}.{name}").collect()]
                gone = [part for part in there if part not in used[name]]
                for at in range(0, len(gone), _AT_ONCE):
                    named = ", ".join(f"PARTITION ({PART} = '{part}')" for part in gone[at : at + _AT_ONCE])
                    self.spark.sql(f"ALTER TABLE {database}.{name} DROP IF EXISTS {named}")
