"""An index that is changed in place at the cost of what a change touches.

The documents of a tenant lie in buckets by the hash of their id. A manifest names the folder that holds each bucket; a
change writes new folders for the buckets it touches and a new manifest that takes all others over. A
version is one commit file, created only if no other publisher has created it before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.text import let
from docsift.operators.maintain import BROADCAST_BYTES, KEYS, unindex, upsert
from docsift.operators.relevance import term_words
from docsift.plans.predicates import condition, terms_query
from docsift.schema import DEFAULT_MAPPING, FieldMapping
from docsift.session import materialize, stored_bytes

BUCKET_ROWS = 1_000_000
RETRIES = 10
# Keys of a long list that a task compares with the documents.
KEYS_PER_TASK = 500_000
MANIFEST = "appid string, buckets int, bucket int, path string, rows bigint"

COUNTS = "array<struct<kind:string,key:string,n:bigint>>"

Place = tuple[str, int]


class Conflict(RuntimeError):
    """Other publishers came first too often."""


@dataclass(frozen=True)
class Version:
    """What a commit file says: its number, the manifest, the schema of the documents, and notes of the publisher."""

    seq: int
    manifest: str
    schema: T.StructType
    notes: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Folder:
    """How many buckets its tenant has, where the bucket lies below `data`, and how many documents it holds."""

    buckets: int
    path: str
    rows: int


class BucketedIndex:
    """`<root>/data/unit=<write>/appid=<tenant>/bucket=<n>/` holds documents, `<root>/_manifests/` and
    `<root>/_commits/` say which of these folders make up a version.

    A reader resolves a version once and reads files that never change. The manifest has a row per folder, which is what
    Spark lists to read a table anyway; it is the only thing that is brought to the driver. Documents need an `appid`
    and an `id` that are not blank (see `split_batch`); those without are left out.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS,
                 sort_by: tuple[str, ...] = ("type", "id"), counted: tuple[str, ...] = (),
                 mapping: FieldMapping = DEFAULT_MAPPING):
        """`counted` names text fields whose term statistics are kept up with every change; all publishers must name the same."""
        self.spark, self.root = spark, root.rstrip("/")
        self.bucket_rows, self.sort_by = bucket_rows, sort_by
        self.counted, self.mapping = counted, mapping

    # ------------------------------------------------------------ files

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _read_text(self, *parts: str) -> str:
        stream = self._fs().open(self._path(*parts))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> bool:
        """Create a commit file with all its contents, or leave the one that is there: False."""
        jvm, fs = self.spark._jvm, self._fs()
        draft, final = self._path("_commits", f".{uuid.uuid4().hex}"), self._path("_commits", name)
        stream = fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            final.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), how)
            return True
        except Exception as error:  # the name of the Java exception is all that py4j hands over
            if "FileAlreadyExistsException" not in str(error):
                raise
            fs.delete(draft, False)
            return False

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self._names("_commits") if n.isdigit())

    def version(self, seq: int) -> Version:
        said = json.loads(self._read_text("_commits", f"{seq:020d}"))
        return Version(seq, said["manifest"], T.StructType.fromJson(said["schema"]), said["notes"])

    def current(self) -> Version | None:
        known = self.versions()
        return self.version(known[-1]) if known else None

    def _require(self, version: Version | None) -> Version:
        version = version or self.current()
        if version is None:
            raise ValueError(f"nothing is published in {self.root}")
        return version

    def folders(self, version: Version | None, appid: str | None = None) -> dict[Place, Folder]:
        """The manifest of a version, of one tenant or all."""
        if version is None:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifests/{version.manifest}")
        if appid is not None:
            rows = rows.filter(F.col("appid") == appid)
        return {(r["appid"], r["bucket"]): Folder(r["buckets"], r["path"], r["rows"]) for r in rows.collect()}

    def publish(self, base: Version | None, folders: Mapping[Place, Folder], schema: T.StructType,
                notes: Mapping[str, Any]) -> Version | None:
        """Make these folders the version after `base`; None if another publisher has done so already."""
        name = uuid.uuid4().hex
        rows = [(a, f.buckets, b, f.path, f.rows) for (a, b), f in sorted(folders.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.root}/_manifests/{name}")
        seq = 1 if base is None else base.seq + 1
        said = json.dumps({"manifest": name, "schema": schema.jsonValue(), "notes": dict(notes)})
        if not self._create(f"{seq:020d}", said):
            self._fs().delete(self._path("_manifests", name), True)
            return None
        return Version(seq, name, schema, dict(notes))

    # ------------------------------------------------------------ reading

    def _read(self, schema: T.StructType, folders: Mapping[Place, Folder]) -> DataFrame:
        """The documents in some folders, with the column `bucket`."""
        columns = [*schema.fieldNames(), "bucket"]
        if not folders:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())]))
        paths = [f"{self.root}/data/{f.path}" for f in folders.values()]
        stored = T.StructType([*[f for f in schema.fields if f.name != "appid"], T.StructField("unit", T.StringType()),
                               T.StructField("appid", T.StringType()), T.StructField("bucket", T.IntegerType())])
        return (self.spark.read.schema(stored).option("basePath", f"{self.root}/data").parquet(*paths)
                .select(*[F.col(f"`{c}`") for c in columns]))

    def read(self, version: Version | None = None, appid: str | None = None) -> DataFrame:
        """The documents of a version, of one tenant or all. Only the folders of that tenant are opened."""
        version = self._require(version)
        return self._read(version.schema, self.folders(version, appid)).drop("bucket")

    def count(self, version: Version | None = None, appid: str | None = None) -> int:
        """The number of documents, from the manifest alone."""
        return sum(f.rows for f in self.folders(self._require(version), appid).values())

    # ------------------------------------------------------------ writing

    def _write(self, docs: DataFrame) -> dict[Place, Folder]:
        """Write documents with their columns `bucket` and `_buckets`; what became of them, by folder. `rebalance`
        splits a bucket that is too large for a task and joins small ones."""
        unit = uuid.uuid4().hex
        path = f"{self.root}/data/unit={unit}"
        order = [c for c in ("appid", "bucket", *self.sort_by) if c in docs.columns]
        (docs.hint("rebalance", "appid", "bucket").sortWithinPartitions(*order)
         .write.partitionBy("appid", "bucket").parquet(path))
        rows = (self._by_file(path).groupBy("appid", "bucket", "_buckets")
                .agg(F.sum("rows").alias("rows"), F.min("file").alias("file")).collect())
        if self.counted:
            self._count(self.spark.read.schema(docs.drop("_buckets").schema).parquet(path), unit)
        # the names of the folders as Spark has written them
        return {(r["appid"], r["bucket"]): Folder(
            r["_buckets"], "/".join(unquote(r["file"]).split("/")[-4:-1]), r["rows"]) for r in rows}

    def _by_file(self, path: str) -> DataFrame:
        """The documents in each file of a write. The file is a key and not an aggregate, for which Spark would sort all
        documents."""
        stored = self.spark.read.schema("_buckets int, appid string, bucket int").parquet(path)
        return stored.groupBy("appid", "bucket", "_buckets", F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("rows"))

    def _count(self, docs: DataFrame, unit: str) -> None:
        """Write the statistics of the folders of a write next to them: documents by type, and for each counted field the
        documents with words, their words, and the documents with each term."""
        none = F.array().cast(COUNTS)

        def item(kind: str, key: Column, n: Column) -> Column:
            return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), n.cast("bigint").alias("n"))

        one = F.lit(1)
        items = [F.array(item("type", F.col("type") if "type" in docs.columns else F.lit(None), one))]
        for name in (c for c in self.counted if c in docs.columns):
            words = term_words(docs, name, self.mapping)
            items.append(let(words, lambda w: F.when(F.size(w) > 0, F.concat(
                F.array(item(f"docs {name}", F.lit(""), one), item(f"words {name}", F.lit(""), F.size(w))),
                F.transform(F.array_distinct(w), lambda t: item(f"term {name}", t, one)))).otherwise(none)))
        rows = docs.select("appid", "bucket", F.inline(F.concat(*[i.cast(COUNTS) for i in items])))
        (rows.groupBy("appid", "bucket", "kind", "key").agg(F.sum("n").alias("n"))
         .hint("rebalance", "appid", "bucket").sortWithinPartitions("appid", "bucket", "kind", "key")
         .write.partitionBy("appid", "bucket").parquet(f"{self.root}/stats/unit={unit}"))

    def statistics(self, version: Version | None = None, appid: str | None = None) -> DataFrame:
        """`(kind, key, n)` of a version: the counts of its folders, which each change has written anew for what it touched.
        They are added up with partial sums; no document is read."""
        if not self.counted:
            raise ValueError("this index was opened without counted fields")
        folders = self.folders(self._require(version), appid).values()
        kinds = "kind string, key string, n bigint"
        if not folders:
            return self.spark.createDataFrame([], kinds)
        rows = self.spark.read.schema(kinds).parquet(*[f"{self.root}/stats/{f.path}" for f in folders])
        return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"))

    def counts_by_type(self, version: Version | None = None, appid: str | None = None) -> DataFrame:
        return self.statistics(version, appid).filter("kind = 'type'").select(F.col("key").alias("type"), "n")

    def term_statistics(self, version: Version | None = None, appid: str | None = None) -> Callable[[str, Column], DataFrame]:
        """For `relevance.search`: what a pass over the texts would count about a field, taken from the kept statistics."""
        def of(field: str, wanted: Column) -> DataFrame:
            rows = self.statistics(version, appid)
            kept = rows.filter(F.col("kind").isin(f"docs {field}", f"words {field}") | (
                (F.col("kind") == f"term {field}") & F.array_contains(wanted, F.col("key"))))
            docs, words = (F.sum(F.when(F.col("kind") == f"{k} {field}", F.col("n"))) for k in ("docs", "words"))
            return kept.agg(F.coalesce(docs, F.lit(0)).alias("n"), (words / docs).alias("avg"), F.map_from_entries(
                F.collect_list(F.when(F.col("kind") == f"term {field}", F.struct("key", "n")))).alias("df"))

        return of

    def _tenants(self, keys: DataFrame, folders: Mapping[Place, Folder]) -> DataFrame:
        """(appid, _buckets) of the tenants in `keys`: as many buckets as they have, or as the keys of a new one need,
        rounded up to a power of two."""
        known = {a: f.buckets for (a, _), f in folders.items()}
        counted = materialize(keys.groupBy("appid").agg(F.count(F.lit(1)).alias("n")), "tenants")
        has = self.spark.createDataFrame(list(known.items()), "appid string, has int")
        need = F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / self.bucket_rows)))).cast("int")
        return counted.join(has, "appid", "left").select("appid", F.coalesce("has", need).alias("_buckets"))

    def _routed(self, rows: DataFrame, tenants: DataFrame) -> DataFrame:
        """Rows with the bucket that they belong to. A tenant may hold most of the rows, so its few numbers are told to all
        tasks as long as they are few."""
        named = rows.filter((F.trim("appid") != "") & (F.trim("id") != ""))
        if stored_bytes(tenants) <= BROADCAST_BYTES:
            tenants = F.broadcast(tenants)
        return named.join(tenants, "appid").withColumn("bucket", bucket_of(F.col("id"), F.col("_buckets")))

    def rebuild(self, docs: DataFrame, notes: Mapping[str, Any] | None = None) -> Version:
        """All documents anew; buckets are dealt afresh. Whatever was published before is replaced."""
        named = docs.filter((F.trim("appid") != "") & (F.trim("id") != ""))
        tenants = materialize(self._tenants(named.select("appid"), {}), "tenants")
        schema = docs.schema
        folders = self._write(self._routed(named, tenants))
        for _ in range(RETRIES):
            done = self.publish(self.current(), folders, schema, notes or {})
            if done is not None:
                return done
        raise Conflict(self.root)

    def change(self, touch: Callable[[Version, dict[Place, Folder]], DataFrame],
               rewrite: Callable[[DataFrame], DataFrame], schema: Callable[[T.StructType], T.StructType] = lambda s: s,
               notes: Callable[[Mapping[str, Any]], Mapping[str, Any]] = lambda n: n, looked: bool = False) -> Version:
        """Publish the current version with some buckets rewritten.

        `touch` names the buckets (appid, bucket, _buckets) from the version, `rewrite` maps their documents to
        new ones. If another publisher comes first, the change is put on top of theirs: only the manifest is
        written again if they left our buckets alone, everything if not. `looked` says that `touch` has looked at
        the documents, so that any other change asks for a new look. Raises `Conflict` after many attempts.
        """
        base, folders = None, {}
        ours: dict[Place, Folder] | None = None
        touched: set[Place] = set()
        for _ in range(RETRIES):
            newest = self._require(None)
            now = self.folders(newest)
            kept = ours is not None and not looked and all(now.get(p) == folders.get(p) for p in touched) and all(
                {f.buckets for (a, _), f in now.items() if a == p[0]} <= {ours[p].buckets} for p in touched if p in ours)
            base, folders = newest, now
            places = None if kept else touch(base, folders)
            wanted = schema(base.schema)
            if places is not None:
                sizes = materialize(places.select("appid", "bucket", "_buckets").distinct(), "touched")
                touched = {(r["appid"], r["bucket"]) for r in sizes.collect()}
                if not touched and notes(base.notes) == base.notes:
                    return base
                old = self._read(wanted, {p: f for p, f in folders.items() if p in touched}).drop("bucket")
                tenants = sizes.select("appid", "_buckets").distinct()
                new = rewrite(old).select(*[F.col(f"`{c}`") for c in wanted.fieldNames()])
                ours = self._write(self._routed(new, tenants)) if touched else {}
            merged = {p: f for p, f in folders.items() if p not in touched} | ours
            done = self.publish(base, merged, wanted, notes(base.notes))
            if done is not None:
                return done
        raise Conflict(self.root)

    def places(self, keys: DataFrame, folders: Mapping[Place, Folder]) -> DataFrame:
        """`keys` with the bucket that each belongs to, and `_buckets`, the number of its tenant's buckets. The tenants'
        numbers are stored, so that Spark knows them to be few: no tenant's keys go to one task."""
        return self._routed(keys, materialize(self._tenants(keys, folders), "tenants"))

    def upsert(self, batch: DataFrame, mode: str = "merge", seq: str = "seq", op: str | None = None,
               notes: Callable[[Mapping[str, Any]], Mapping[str, Any]] = lambda n: n) -> Version:
        """Puts (and with `op` deletes) in the order of `seq` on top of what is published, see `maintain.upsert`. The
        batch is read several times: store it first if it is costly. Its new columns are added to the index."""
        batch = batch.filter((F.trim("appid") != "") & (F.trim("id") != ""))
        keys = materialize(batch.select(*KEYS).distinct(), "keys")
        more = [f for f in batch.schema.fields if f.name not in (seq, op)]
        return self.change(lambda _, folders: self.places(keys, folders), lambda old: upsert(old, batch, mode, KEYS, seq, op),
                           lambda known: wider(known, more), notes)

    def delete_ids(self, gone: DataFrame) -> Version:
        """Without the listed keys; only buckets that hold one of them are written. The list may be much longer than the
        index: it meets the documents once, a bounded number of keys in a task, and the keys found there are all that the
        buckets are rewritten with. Keys that are listed again are left out where they meet the documents."""
        gone = materialize(gone.select(*KEYS), "gone")
        listed = gone.count()
        found: list[DataFrame] = []

        def touch(version: Version, folders: dict[Place, Folder]) -> DataFrame:
            routed = self.places(gone, folders)
            near = materialize(routed.select("appid", "bucket").distinct(), "near")
            near = {(r["appid"], r["bucket"]) for r in near.collect()}
            near = {p: f for p, f in folders.items() if p in near}
            held, keys = self._read(version.schema, near).select(*KEYS, "bucket"), gone
            parts = -(-max(listed, sum(f.rows for f in near.values())) // KEYS_PER_TASK)
            if listed > KEYS_PER_TASK:
                parts = max(parts, self.spark.sparkContext.defaultParallelism)
                held, keys = held.repartition(parts, *KEYS), keys.repartition(parts, *KEYS).distinct()
            found[:] = [materialize(held.join(keys, list(KEYS), "left_semi"), "found")]
            sizes = self.spark.createDataFrame(list({a: f.buckets for (a, _), f in near.items()}.items()),
                                               "appid string, _buckets int")
            return found[0].select("appid", "bucket").distinct().join(sizes, "appid")

        return self.change(touch, lambda old: unindex(old, found[0]), looked=True)

    def delete_terms(self, terms: Mapping[str, Any], match_all: bool = True,
                     mapping: FieldMapping = DEFAULT_MAPPING) -> Version:
        """Without the documents that match; the others' buckets stay as they are. Without a usable term nothing happens."""
        query = terms_query(terms, match_all) if terms else None
        if query is None:
            return self._require(None)
        return self.change(lambda v, f: self.matching(v, f, lambda docs: condition(docs, query, mapping)),
                           lambda old: old.filter(~F.coalesce(condition(old, query, mapping), F.lit(False))), looked=True)

    def matching(self, version: Version, folders: Mapping[Place, Folder],
                 where: Callable[[DataFrame], Column]) -> DataFrame:
        """The buckets with a document that matches; only the columns of the condition are read."""
        docs = self._read(version.schema, folders)
        hits = docs.filter(where(docs)).select("appid", "bucket").distinct()
        sizes = self.spark.createDataFrame(list({a: f.buckets for (a, _), f in folders.items()}.items()),
                                           "appid string, _buckets int")
        return hits.join(sizes, "appid")

    def drop_tenant(self, appid: str) -> Version:
        """Without a tenant. No document is read or written: the next manifest leaves its folders out."""
        for _ in range(RETRIES):
            base = self._require(None)
            left = {p: f for p, f in self.folders(base).items() if p[0] != appid}
            done = self.publish(base, left, base.schema, base.notes)
            if done is not None:
                return done
        raise Conflict(self.root)

    def clean(self, keep: int = 2) -> list[str]:
        """Remove all but the last `keep` versions and the writes that none of these uses; readers of an older version must
        be done. A write that is being published is not in any version yet: clean when no change runs."""
        kept = self.versions()[-keep:] if keep else []
        if not kept:
            return []
        versions = [self.version(seq) for seq in kept]
        used = {f.path.split("/")[0] for v in versions for f in self.folders(v).values()}
        fs = self._fs()
        unused = [n for n in self._names("data") if n not in used]
        for name in unused:
            fs.delete(self._path("data", name), True)
            fs.delete(self._path("stats", name), True)
        for seq in self.versions():
            if seq < kept[0]:
                fs.delete(self._path("_manifests", self.version(seq).manifest), True)
                fs.delete(self._path("_commits", f"{seq:020d}"), False)
        return unused


def bucket_of(id: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(id.cast("string")), buckets).cast("int")


def wider(schema: T.StructType, fields: Iterable[T.StructField]) -> T.StructType:
    """A schema with the fields that it lacks."""
    known = set(schema.fieldNames())
    return T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType) for f in fields if f.name not in known]])
