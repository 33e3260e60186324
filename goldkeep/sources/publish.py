"""Write-audit-publish of related tables: readers see a complete, checked set or the one before.

A publication writes its tables once, under a new version, and checks all keys there. Only then
is the version entered in the list of publications under the next free number, by creating an
entry that must not exist yet; readers take the latest entry. Until the entry is complete nothing
changes for them, whenever the job stops. Of two publishers who try one number at once only one
can create it; the other reads the list again and takes the next. A version that fails its
checks is removed, and so are listed versions before the last two, which no reader starts with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldkeep.operators.constraints import fk_violations, pk_violations
from goldkeep.shared import create_text, file_names, read_text, remove_path

Sink = Callable[[str, DataFrame], None]


class PrimaryKey(NamedTuple):
    table: str
    columns: list[str]


class ForeignKey(NamedTuple):
    table: str
    column: str
    parent: str
    parent_column: str


class Publication(NamedTuple):
    """An entry of the list; without a version it is not complete."""

    number: int
    version: str | None
    tables: list[str]


class ConstraintError(ValueError):
    """Raised before publishing; ``problems`` counts violations per constraint."""

    def __init__(self, problems: dict[str, int]):
        super().__init__(f"nothing was published: {problems}")
        self.problems = problems


class ParquetStore:
    """Versions as folders ``folder/version/table``, publications as files in ``folder/list``."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def write(self, version: str, name: str, df: DataFrame) -> None:
        df.write.parquet(f"{self.folder}/{version}/{name}")

    def read(self, spark: SparkSession, version: str, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{version}/{name}")

    def _entry(self, number: int) -> str:
        return f"{self.folder}/list/{number:012d}.json"

    def add(self, spark: SparkSession, entry: Publication) -> bool:
        text = json.dumps({"version": entry.version, "tables": entry.tables})
        return create_text(spark, self._entry(entry.number), text)

    def publications(self, spark: SparkSession) -> list[Publication]:
        numbers = [int(n.removesuffix(".json")) for n in file_names(spark, f"{self.folder}/list")]
        found = []
        for number in numbers:
            try:  # an entry that is being written, or was left so, is no publication yet
                said = json.loads(read_text(spark, self._entry(number)) or "")
            except ValueError:
                said = {"version": None, "tables": []}
            found.append(Publication(number, said["version"], said["tables"]))
        return found

    def forget(self, spark: SparkSession, number: int) -> None:
        remove_path(spark, self._entry(number))

    def show(self, spark: SparkSession, version: str, names: list[str]) -> None:
        """Readers resolve the latest entry by themselves."""

    def remove(self, spark: SparkSession, version: str, names: list[str]) -> None:
        remove_path(spark, f"{self.folder}/{version}")


class CatalogStore:
    """Versions as catalog tables ``prefix + table + _version`` behind views without version."""

    def __init__(self, database: str | None = None, prefix: str = ""):
        self.start = (f"{database}." if database else "") + prefix

    def _table(self, version: str, name: str) -> str:
        return f"{self.start}{name}_{version}"

    def write(self, version: str, name: str, df: DataFrame) -> None:
        df.write.saveAsTable(self._table(version, name))

    def read(self, spark: SparkSession, version: str, name: str) -> DataFrame:
        return spark.table(self._table(version, name))

    def _entry(self, number: int) -> str:
        return f"{self.start}publication_{number:012d}"

    def add(self, spark: SparkSession, entry: Publication) -> bool:
        """The entry is an empty table with its content in properties: creating it is one step."""
        said = json.dumps({"version": entry.version, "tables": entry.tables}).replace("'", "\\'")
        try:
            spark.sql(
                f"create table {self._entry(entry.number)} (entry string) using parquet "
                f"tblproperties ('publication' = '{said}')"
            )
        except AnalysisException as refused:
            if refused.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
            return False
        return True

    def publications(self, spark: SparkSession) -> list[Publication]:
        database, _, prefix = self.start.rpartition(".")
        within = f"in {database} " if database else ""
        found = []
        for row in spark.sql(f"show tables {within}like '{prefix}publication_*'").collect():
            number = int(row["tableName"].rpartition("_")[2])
            name = f"{database}.{row['tableName']}" if database else row["tableName"]
            try:
                (said,) = spark.sql(f"show tblproperties {name} ('publication')").collect()
            except AnalysisException:  # forgotten since the list was read
                continue
            said = json.loads(said["value"])
            found.append(Publication(number, said["version"], said["tables"]))
        return sorted(found)

    def forget(self, spark: SparkSession, number: int) -> None:
        spark.sql(f"drop table if exists {self._entry(number)}")

    def show(self, spark: SparkSession, version: str, names: list[str]) -> None:
        for name in names:
            spark.sql(
                f"create or replace view {self.start}{name} as "
                f"select * from {self._table(version, name)}"
            )

    def remove(self, spark: SparkSession, version: str, names: list[str]) -> None:
        for name in names:
            spark.sql(f"drop table if exists {self._table(version, name)}")


def jdbc_sink(url: str, properties: dict[str, str]) -> Sink:
    """Replace tables of a relational database, to export a published set."""
    return lambda name, df: df.write.mode("overwrite").jdbc(url, name, properties=properties)


def audit(
    tables: dict[str, DataFrame], primary: list[PrimaryKey], foreign: list[ForeignKey]
) -> dict[str, int]:
    """Number of violating keys of each broken constraint, all checks in one job."""
    checks = {f"primary key {p.table}": pk_violations(tables[p.table], p.columns) for p in primary}
    for f in foreign:
        checks[f"foreign key {f.table}.{f.column}"] = fk_violations(
            tables[f.table], f.column, tables[f.parent], f.parent_column
        )
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in checks.items()
    ]
    if not counts:
        return {}
    merged = counts[0]
    for one in counts[1:]:
        merged = merged.union(one)
    return {r.name: r.n for r in merged.where("n > 0").collect()}


def _latest(spark: SparkSession, store: ParquetStore | CatalogStore) -> Publication | None:
    complete = [p for p in store.publications(spark) if p.version is not None]
    return complete[-1] if complete else None


def _enter(spark: SparkSession, store: ParquetStore | CatalogStore, version: str, names: list[str]) -> None:
    """Give ``version`` the next free number, however many try at once."""
    while True:
        listed = store.publications(spark)
        number = listed[-1].number + 1 if listed else 0
        if store.add(spark, Publication(number, version, names)):
            return


def _show_latest(spark: SparkSession, store: ParquetStore | CatalogStore) -> None:
    """Point readers to the latest publication; if another came meanwhile, to that one."""
    shown = None
    while (latest := _latest(spark, store)) != shown:
        store.show(spark, latest.version, latest.tables)
        shown = latest


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    store: ParquetStore | CatalogStore,
    primary: list[PrimaryKey],
    foreign: list[ForeignKey],
) -> dict[str, DataFrame]:
    """Write ``tables`` as a new version, check its constraints, then point readers to it."""
    version, names = uuid.uuid4().hex, list(tables)
    try:
        for name, df in tables.items():
            store.write(version, name, df)
        written = {name: store.read(spark, version, name) for name in names}
        problems = audit(written, primary, foreign)
        if problems:
            raise ConstraintError(problems)
    except Exception:
        store.remove(spark, version, names)
        raise
    _enter(spark, store, version, names)
    _show_latest(spark, store)
    # whoever reads the version before the latest can finish; older ones are gone
    complete = [p for p in store.publications(spark) if p.version is not None]
    for old in complete[:-2]:
        store.remove(spark, old.version, old.tables)
        store.forget(spark, old.number)
    return written


def published(spark: SparkSession, store: ParquetStore | CatalogStore, name: str) -> DataFrame:
    """The table ``name`` of the latest publication."""
    latest = _latest(spark, store)
    if latest is None:
        raise LookupError("nothing has been published")
    return store.read(spark, latest.version, name)
