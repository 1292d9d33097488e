"""The registry of documents by content hash: upsert, work lists, state, storage.

A registry is a table of schema.ENTRY with one row per SHA-256. Stored, it is a folder of bases, deltas over them, and
numbered pointer files, the highest of which names the current ones; so readers never see half a commit, a commit writes in
proportion to what it changes, two writers at once lose nothing, and a run that is lost between two steps leaves the state before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import glob
from ..schema import ENTRY

STEPS = ("step1", "translation_md", "translation_docx", "summary")


def arrivals(files: DataFrame, sha: str = "sha256", name: str = "name", order: str = "path") -> DataFrame:
    """(sha256, names): the names of each content in order of arrival, without repeats."""
    seen = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(name).alias("n"))))
    return files.groupBy(F.col(sha).alias("sha256")).agg(F.array_distinct(F.transform(seen, lambda x: x["n"])).alias("names"))


def deduplicated(files: DataFrame, sha: str = "sha256", name: str = "name", order: str = "path") -> DataFrame:
    """sha256, original_name and duplicates of each content."""
    a = arrivals(files, sha, name, order)
    return a.select("sha256", F.get("names", 0).alias("original_name"), F.slice("names", 2, F.greatest(F.size("names") - 1, F.lit(0))).alias("duplicates"))


def upsert(registry: DataFrame, files: DataFrame, **columns) -> DataFrame:
    """The registry with new contents added and further names of known ones listed as duplicates, each once."""
    new = arrivals(files, **columns).withColumnRenamed("sha256", "_sha")
    both = registry.join(new, registry["sha256"] == new["_sha"], "full")
    names = F.coalesce("names", F.array().cast("array<string>"))
    name = F.coalesce("original_name", F.get("names", 0))
    known = F.coalesce("duplicates", F.array().cast("array<string>"))
    return both.withColumns(
        {
            "original_name": name,
            "duplicates": F.array_union(known, F.array_except(names, F.array(name))),
            "page_count": F.coalesce("page_count", F.lit(0)),
            "has_pictures": F.coalesce("has_pictures", F.lit(False)),
            "sha256": F.coalesce("sha256", "_sha"),
        }
    ).select(*registry.columns)


def upserted(registry: DataFrame, files: DataFrame, **columns) -> DataFrame:
    """The rows of upsert() that are new or changed; only entries of the files' contents are looked at."""
    sha = F.col(columns.get("sha", "sha256")).alias("sha256")
    own = registry.join(files.select(sha).distinct(), "sha256", "left_semi")
    return upsert(own, files, **columns).subtract(own)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ENTRY)


def by_name(df: DataFrame) -> DataFrame:
    """In order of the lower-cased name, then of the hash."""
    return df.orderBy(F.lower(F.coalesce("original_name", F.lit(""))), "sha256")


def only(df: DataFrame, pattern: str, name: str = "original_name") -> DataFrame:
    return df.filter(glob(F.col(name), pattern))


def with_sha_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.filter(F.col("sha256").startswith(prefix))


def is_pending(status: Column, force: bool = False) -> Column:
    return F.lit(True) if force else ~status.eqNullSafe("done")


def is_eligible(step1: Column) -> Column:
    return step1["status"].eqNullSafe("done") & step1["md_relpath"].isNotNull()


def is_translated(status: Column, force: bool = False) -> Column:
    return F.lit(False) if force else F.coalesce(status.isin("done", "already_hebrew"), F.lit(False))


def in_target_language(lang: Column, target: tuple[str, ...] = ("he", "iw"), skip: bool = True) -> Column:
    return F.coalesce(lang.isin(*target), F.lit(False)) & F.lit(skip)


def needs_ocr(chars: Column, least: int = 200, when_empty: bool = True, force: bool = False) -> Column:
    return F.lit(force) | (F.lit(when_empty) & (F.coalesce(chars, F.lit(0)) < least))


def work_list(df: DataFrame, pending: Column, limit: int | None = None) -> DataFrame:
    """What is pending, in order of names; with a limit the first of it (0: none)."""
    out = by_name(df.filter(pending))
    return out if limit is None else out.limit(limit)


def without_errors(df: DataFrame, step: str = "translation_docx") -> DataFrame:
    return df.filter(~F.col(step)["status"].eqNullSafe("error"))


def existing(df: DataFrame, listing: DataFrame, path: str, how: str = "left_semi") -> DataFrame:
    """Rows whose path is listed (left_semi) or isn't (left_anti)."""
    here = listing.select(F.col("path").alias("_path"))
    return df.join(here, F.col(path) == F.col("_path"), how)


def merge_step(registry: DataFrame, results: DataFrame, step: str) -> DataFrame:
    """The registry with column step replaced by the results' (sha256, step) where there is one."""
    new = results.select(F.col("sha256").alias("_sha"), F.col(step).alias("_new"))
    both = registry.join(new, registry["sha256"] == new["_sha"], "left")
    return both.withColumn(step, F.coalesce("_new", step)).select(*registry.columns)


# ---------------------------------------------------------------- storage
#
# A stored table of rows by key: the registry, and others of their own schema and key. A pointer names a base, written whole in
# BUCKETS folders by the key's hash, and the deltas over it, in order: whole rows of new or changed keys. A commit is a pointer with
# the next number, which only one writer can take.

_POINTER = "CURRENT-"
BUCKETS, MOST_DELTAS = 16, 24  # BUCKETS is a part of the format


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, file name) of the pointers, the highest number last."""
    fs, folder = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted((int(n[len(_POINTER) :]), n) for n in names if n.startswith(_POINTER) and n[len(_POINTER) :].isdigit())


def _named(spark: SparkSession, path: str, pointer: str) -> list[str]:
    """The base and the deltas that a pointer names."""
    fs, file = _fs(spark, f"{path}/{pointer}")
    read = spark._jvm.org.apache.commons.io.IOUtils
    stream = fs.open(file)
    try:
        return read.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def _state(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The current pointer's number, 0 where there is none, and what it names."""
    for _ in range(20):
        found = _pointers(spark, path)
        try:
            return (found[-1][0], _named(spark, path, found[-1][1])) if found else (0, [])
        except Py4JJavaError as e:  # a later commit has deleted it meanwhile
            if "FileNotFoundException" not in str(e.java_exception):
                raise
    raise OSError(f"the pointers of {path} change too fast")


def current(spark: SparkSession, path: str) -> str | None:
    """The name of the current base, None where there is none."""
    names = _state(spark, path)[1]
    return names[0] if names else None


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _merged(spark: SparkSession, path: str, names: list[str], schema: str, key: str) -> DataFrame:
    """The rows of a base and its deltas: of each key those of the last delta that has it."""
    part = lambda name: spark.read.schema(schema).parquet(f"{path}/{name}")
    if not names:
        return spark.createDataFrame([], schema)
    base = part(names[0])
    base = base.drop("bucket") if "bucket" in base.columns else base
    if len(names) == 1:
        return base
    late = part(names[1]).withColumn("_n", F.lit(1))
    for i, name in enumerate(names[2:], 2):
        late = late.unionByName(part(name).withColumn("_n", F.lit(i)))
    columns = base.columns
    late = late.groupBy(key).agg(F.max_by(F.struct(*columns), "_n").alias("_row")).select("_row.*")
    return base.join(late.select(key), key, "left_anti").select(*columns).unionByName(late)


def load(spark: SparkSession, path: str, schema: str = ENTRY, key: str = "sha256") -> DataFrame:
    return _merged(spark, path, _state(spark, path)[1], schema, key)


def _new_base(df: DataFrame, path: str, key: str) -> str:
    version = f"v-{uuid.uuid4().hex}"
    df.withColumn("bucket", _bucket(key)).repartition(BUCKETS, "bucket").write.partitionBy("bucket").parquet(f"{path}/{version}")
    return version


def save(df: DataFrame, path: str, key: str = "sha256") -> str:
    """Writes a whole new base, then a pointer with the next number. What other writers have committed since df was read is
    lost: update() keeps it.

    A driver that is lost at any step leaves the highest pointer and what it names whole. What the pointer before names stays until the
    commit after the next; only what an older pointer names is deleted, never a folder that no pointer names."""
    spark = df.sparkSession
    before = _state(spark, path)[0]
    version = _new_base(df, path, key)
    _point(spark, path, version, before + 1)
    _cleared(spark, path)
    return version


def update(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], schema: str = ENTRY, key: str = "sha256", tries: int = 50) -> int:
    """Commits the rows that change(current table) gives, whole rows of new or changed keys, as a delta; returns its pointer's
    number. What is written is in proportion to those rows. If another writer commits first, the change is made again
    upon what that one has left. After MOST_DELTAS deltas the table is written whole."""
    for _ in range(tries):
        number, names = _state(spark, path)
        delta = f"d-{uuid.uuid4().hex}"
        change(_merged(spark, path, names, schema, key)).write.parquet(f"{path}/{delta}")
        if spark.read.schema(schema).parquet(f"{path}/{delta}").isEmpty():
            _delete(spark, f"{path}/{delta}")
            return number
        try:
            if not names:  # the first rows are a base
                names = [_new_base(spark.createDataFrame([], schema), path, key)]
            _point(spark, path, "\n".join([*names, delta]), number + 1)
        except FileExistsError:
            _delete(spark, f"{path}/{delta}")
            continue
        if len(names) >= MOST_DELTAS:
            compact(spark, path, schema, key)
        _cleared(spark, path)
        return number + 1
    raise OSError(f"other writers of {path} were always first")


def compact(spark: SparkSession, path: str, schema: str = ENTRY, key: str = "sha256") -> None:
    """A new base of the current rows; if another writer commits meanwhile, the old base and deltas stay and nothing is lost."""
    number, names = _state(spark, path)
    if len(names) < 2:
        return
    version = _new_base(_merged(spark, path, names, schema, key), path, key)
    try:
        _point(spark, path, version, number + 1)
    except FileExistsError:
        _delete(spark, f"{path}/{version}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _cleared(spark: SparkSession, path: str) -> None:
    """Deletes all but the last two pointers, and what only those name."""
    found = _pointers(spark, path)
    kept = {n for _, p in found[-2:] for n in _named(spark, path, p)}
    for _, pointer in found[:-2]:
        try:
            for name in _named(spark, path, pointer):
                if name not in kept:
                    _delete(spark, f"{path}/{name}")
            _delete(spark, f"{path}/{pointer}")
        except Py4JJavaError as e:  # another writer has cleared it
            if "FileNotFoundException" not in str(e.java_exception):
                raise


def _point(spark: SparkSession, path: str, names: str, number: int) -> None:
    """Makes a pointer under its number, whole and at once; FileExistsError where another writer has taken the number.

    On local files by a hard link, elsewhere by a rename that doesn't replace, which HDFS does in one step. On an object
    store, which has neither, one writer at a time is assumed."""
    jvm = spark._jvm
    fs, made = _fs(spark, f"{path}/_{uuid.uuid4().hex}")
    out = fs.create(made, True)
    out.write(bytearray(f"{names}\n".encode()))
    out.close()
    _, pointer = _fs(spark, f"{path}/{_POINTER}{number:012d}")
    local = lambda p: jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath()
    try:
        if fs.getScheme() == "file":
            jvm.java.nio.file.Files.createLink(local(pointer), local(made))
        else:
            options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(made, pointer, options)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception):
            raise FileExistsError(f"another writer has saved {path} meanwhile") from e
        raise
    finally:
        fs.delete(made, False)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A registry kept as one JSON object of entries by hash."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", f"map<string, struct<{_as_struct(ENTRY)}>>")
    rows = text.select(F.explode(entries).alias("_sha", "e"))
    rest = [F.col(f"e.{c}").alias(c) for c in empty(spark).columns if c != "sha256"]
    return rows.select(F.coalesce("e.sha256", "_sha").alias("sha256"), *rest)


def _as_struct(ddl: str) -> str:
    """Top-level fields of a DDL list in the notation of a struct's fields."""
    out, depth, part = [], 0, ""
    for c in ddl + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            part = ""
        else:
            part += c
    return ", ".join(out)


def write_json(df: DataFrame, path: str) -> None:
    """One line per entry in order of hashes, keys sorted by the schema; non-ASCII text as it is."""
    df.orderBy("sha256").select(F.to_json(F.struct(*sorted(df.columns))).alias("value")).write.text(path)
