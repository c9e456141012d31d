"""Crawl state as versioned parquet.

Settled pages, their texts, links, sites, images and page data are only ever added to, one
directory ``v=N`` per round. Texts are a table of their own, which meets pages by (id, text_no) where it is wanted. Open pages (FRONTIER, CRAWLING: no text) are a base with the rows that were added and the
ids that were removed since, so a version writes no more than its batch; they are folded into a new base
when the changes have grown beyond a share of it. Beside the tables are indexes from URLs and content hashes to ids.
A version counts once its row in ``_commits`` is there, so readers never see half a round, and a
repeated attempt overwrites what a failed one left behind. The commit also has the counts and largest ids.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.operators.sizes import small
from linkloom.sources.keys import KeyIndex, Point, Sizes

if TYPE_CHECKING:
    from linkloom.plans.rounds import Changes

OPEN_STATES = ("FRONTIER", "CRAWLING")
_ADDED = ("site", "link", "page_data", "image")
_NUMBERED = ("page", "site", "page_data", "image")
_KEYS = ("url", "content_hash")
_COMMIT = "version int, base int, html_pages bigint, frontier_pages bigint, stream string, batch bigint, state string"


@dataclass(frozen=True)
class Status:
    """A committed version. ``open_base`` is the version of the base of open pages, ``open_rows`` its rows, ``open_changes`` the
    rows added and ids removed since; ``keys`` has the point of each index, ``last_ids`` the largest id of each table."""

    version: int
    base: int
    html_pages: int
    frontier_pages: int
    stream: str | None = None
    batch: int | None = None
    open_base: int | None = None
    open_rows: int = 0
    open_changes: int = 0
    keys: dict[str, Point] = field(default_factory=dict)
    last_ids: dict[str, int] = field(default_factory=dict)


class Store:
    def __init__(self, spark: SparkSession, root: str, sizes: Sizes = Sizes()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.sizes = sizes
        self.indexes = {key: KeyIndex(spark, self.root, key, sizes) for key in _KEYS}

    def status(self) -> Status | None:
        """The newest committed version; its counts were taken when it was written."""
        return self._newest(F.lit(True))

    def applied(self, stream: str, batch: int) -> bool:
        """Whether a version holds this micro-batch of the stream, or a later one."""
        return self._newest((F.col("stream") == stream) & (F.col("batch") >= batch)) is not None

    def _newest(self, condition: Column) -> Status | None:
        try:
            commits = self.spark.read.schema(_COMMIT).json(f"{self.root}/_commits/*")
            row = commits.filter(condition).orderBy(F.col("version").desc()).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if row is None:
            return None
        state = json.loads(row.state)
        state["keys"] = {key: Point(**point) for key, point in state["keys"].items()}
        return Status(row.version, row.base, row.html_pages, row.frontier_pages, row.stream, row.batch, **state)

    def read(self) -> dict[str, DataFrame]:
        """All tables at the newest version; ``page`` has the columns of ``schemas.PAGE_STATE``."""
        status = self._committed()
        tables = {name: self._added(name, status) for name in _ADDED}
        tables["page"] = self._added("page_settled", status).unionByName(self._open(status))
        tables["page_text"] = self._added("page_text", status)
        return tables

    def _committed(self) -> Status:
        status = self.status()
        if status is None:
            raise ValueError(f"nothing committed in {self.root}")
        return status

    def settled(self, first: int, last: int) -> DataFrame:
        """The pages that the versions from ``first`` to ``last`` settled."""
        return self._between("page_settled", first, last)

    def known(self, key: str, batch: DataFrame, status: Status) -> DataFrame:
        """(key, id) of the pages whose ``url`` or ``content_hash`` is in ``batch``, from the index of it."""
        return self.indexes[key].lookup(batch, status.keys[key], status.version)

    def replace(self, tables: dict[str, DataFrame]) -> Status:
        """Write whole tables as a new base; older versions are no longer read.

        ``page`` has its texts as ``html_content``, or else they are in ``page_text``, of which just those are kept that pages have.
        """
        before = self.status()
        version = 0 if before is None else before.version + 1
        page = tables["page"]
        for name in _ADDED:
            self._write(tables.get(name, schemas.empty(self.spark, name)), name, version)
        settled = page.filter(~F.col("page_type_code").isin(*OPEN_STATES))
        if "html_content" in page.columns:
            settled = settled.withColumn("text_no", F.when(F.col("html_content").isNotNull(), 0))
            texts = settled.filter("text_no = 0")
        else:
            texts = schemas.fitted(tables["page_text"], "page_text").join(settled.select("id", "text_no"), ["id", "text_no"], "left_semi")
        self._write(texts, "page_text", version)
        self._write_settled(settled, version)
        self._write(page.filter(F.col("page_type_code").isin(*OPEN_STATES)), "open_added", version)
        written = Status(version, version, 0, 0, open_base=version)
        whole = self._added("page_settled", written).unionByName(self._open(written))
        keys = {key: index.write_base(whole, version) for key, index in self.indexes.items()}
        opened = self._open(written).groupBy("page_type_code").count().collect()
        return self._commit(Status(
            version, version, self._html(version), sum(r["count"] for r in opened if r.page_type_code == "FRONTIER"), open_base=version,
            open_rows=sum(r["count"] for r in opened), keys=keys, last_ids=self._largest(written, {}),
        ))

    def compact(self) -> Status:
        """The same rows as a new base, so that readers list one folder a table. Streams go on where they were: their
        commits stay, and the counts are taken anew."""
        return self.replace(self.read())

    def append(self, changes: Changes, stream: str | None = None, batch: int | None = None) -> Status:
        """Add the changes of one round, or of a micro-batch of a stream, as the next version. What is written follows
        the batch, but for versions that fold the open pages or an index."""
        before = self._committed()
        version = before.version + 1
        for name in _ADDED:
            self._write(getattr(changes, name), name, version)
        self._write_settled(changes.settled, version)
        self._write(changes.texts, "page_text", version)
        self._write(changes.frontier, "open_added", version)
        # Which rows were settled is read back from what was just written: ids only.
        settled, fresh = self._version("page_settled", version), self._version("open_added", version)
        opened = self._open(before).select("id", "page_type_code").join(small(settled.select("id")), "id", "left_semi")
        opened.write.mode("overwrite").parquet(self._path("open_removed", version))
        removed = self._removed(version, version)
        counts = removed.select(F.lit(-1).alias("n"), "page_type_code").unionByName(fresh.select(F.lit(1).alias("n"), "page_type_code"))
        frontier = F.coalesce(F.sum(F.when(F.col("page_type_code") == "FRONTIER", F.col("n"))), F.lit(0))
        moved, net, more = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), frontier).first()
        new = {"url": fresh.select("url", "id").unionByName(settled.join(small(removed.select("id")), "id", "left_anti").select("url", "id")),
               "content_hash": settled.select("content_hash", "id")}
        keys = {key: index.add(new[key], version, before.keys[key]) for key, index in self.indexes.items()}
        after = Status(
            version, before.base, before.html_pages + self._html(version), before.frontier_pages + more, stream, batch, before.open_base,
            before.open_rows, before.open_changes + moved, keys, self._largest(Status(version, version, 0, 0, open_base=version), before.last_ids),
        )
        if after.open_changes > max(self.sizes.fold_rows, self.sizes.fold_share * after.open_rows):
            after = self._fold(after)
        return self._commit(after)

    def _fold(self, status: Status) -> Status:
        """Open pages in one table again, for readers of this version and later ones."""
        version = status.version
        path = self._path("open_folded", version)
        self._open(status).write.mode("overwrite").parquet(path)
        rows = self.spark.read.schema(schemas.PAGE_STATE).parquet(path).count()
        return Status(**{**vars(status), "open_base": version, "open_rows": rows, "open_changes": 0})

    def write_rejects(self, rows: DataFrame, version: int) -> None:
        """Keep arrived rows (id, url) that a version could not take."""
        rows.select("id", "url").write.mode("overwrite").parquet(self._path("rejects", version))

    def rejects(self) -> DataFrame:
        """(id, url, v): the arrived rows that were not taken, by version."""
        return self.spark.read.schema("id bigint, url string, v int").parquet(f"{self.root}/rejects")

    def _path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v={version}"

    def _write(self, df: DataFrame, table: str, version: int) -> None:
        rows = schemas.fitted(df, "page_state" if table == "open_added" else table)
        rows.write.mode("overwrite").parquet(self._path(table, version))

    def _write_settled(self, df: DataFrame, version: int) -> None:
        rows = schemas.fitted(df, "page_state")
        rows.write.mode("overwrite").partitionBy("page_type_code").parquet(self._path("page_settled", version))

    def _between(self, table: str, first: int, last: int) -> DataFrame:
        """Rows of the versions from ``first`` to ``last``; versions are pruned as partitions."""
        schema = schemas.TABLES.get(table, schemas.PAGE_STATE)
        stored = self.spark.read.schema(f"{_ddl(schema)}, v int").parquet(f"{self.root}/{table}")
        return stored.filter(F.col("v").between(first, last)).select(*schema.names)

    def _version(self, table: str, version: int) -> DataFrame:
        return self._between(table, version, version)

    def _added(self, table: str, status: Status) -> DataFrame:
        return self._between(table, status.base, status.version)

    def _removed(self, first: int, last: int) -> DataFrame:
        removed = self.spark.read.schema("id bigint, page_type_code string, v int").parquet(f"{self.root}/open_removed")
        return removed.filter(F.col("v").between(first, last)).select("id", "page_type_code")

    def _open(self, status: Status) -> DataFrame:
        """The open pages: those of the base and the later versions, without the ids removed since."""
        base, last = status.open_base, status.version
        folded = base > status.base
        rows = self._version("open_folded", base) if folded else self._version("open_added", base)
        if last == base:
            return rows
        rows = rows.unionByName(self._between("open_added", base + 1, last))
        return rows.join(self._removed(base + 1, last).select("id"), "id", "left_anti").select(*schemas.PAGE_STATE.names)

    def _html(self, version: int) -> int:
        return self._version("page_settled", version).filter(F.col("page_type_code") == "HTML").count()

    def _largest(self, written: Status, before: dict[str, int]) -> dict[str, int]:
        """The largest id of each table, from what ``written`` added to it."""
        page = self._added("page_settled", written).select("id").unionByName(self._version("open_added", written.version).select("id"))
        tables = {name: self._version(name, written.version) for name in _NUMBERED if name != "page"} | {"page": page}
        every = None
        for name, rows in tables.items():
            one = rows.agg(F.max("id").alias("id")).select(F.lit(name).alias("name"), "id")
            every = one if every is None else every.unionByName(one)
        return {row.name: max(row.id or 0, before.get(row.name, 0)) for row in every.collect()}

    def _commit(self, status: Status) -> Status:
        state = asdict(status)
        fixed = [state.pop(name) for name in ("version", "base", "html_pages", "frontier_pages", "stream", "batch")]
        row = self.spark.createDataFrame([(*fixed, json.dumps(state))], _COMMIT)
        row.coalesce(1).write.mode("overwrite").json(f"{self.root}/_commits/{status.version}")
        return status


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
