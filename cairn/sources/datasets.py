"""Scans of the data model: index, similarity tables, clusters, links, splits, and the ids they are read by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn import schemas
from cairn.functions.filters import select_where

#: Columns of the index that aren't queried, unless asked for.
DENIED = ("ligand_binding_affinity", "system_has_binding_affinity")
DEFAULT_SPLITS = ("train", "val")


def scan(spark: SparkSession, path: str, *, filename: bool = False, merge: bool = False) -> DataFrame:
    """A Parquet file or folder; partition folders become columns. ``filename`` adds the file each row is from."""
    df = spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
    return df.withColumn("filename", F.col("_metadata.file_path")) if filename else df


def with_splits(index: DataFrame, splits: DataFrame, *, wanted: Sequence[str] = DEFAULT_SPLITS, key: str = "system_id") -> DataFrame:
    """Rows of the index with their split, ``unassigned`` where there is none; only ``wanted`` ones unless that is ``*``."""
    found = index.join(splits.select(key, "split"), key, "left").withColumn("split", F.coalesce("split", F.lit("unassigned")))
    return found if "*" in wanted else found.where(F.col("split").isin(list(wanted)))


def query_index(
    index: DataFrame,
    splits: DataFrame | None = None,
    *,
    columns: Sequence[str] | None = None,
    wanted: Sequence[str] = DEFAULT_SPLITS,
    filters: Sequence | None = None,
    key: str = "system_id",
    entry: str = "entry_pdb_id",
    denied: Sequence[str] = DENIED,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Index rows of the wanted splits. The system id always comes first; ``dates`` replaces release dates by entry.

    An entry without a date in ``dates`` keeps its own: the table of corrections is no filter.
    """
    columns = list(columns or [key, entry])
    if columns != ["*"]:
        columns = list(dict.fromkeys([key, *columns, *(["split"] if splits is not None else [])]))
    if dates is not None and "entry_release_date" in index.columns:
        fixed = dates.select(entry, F.col("entry_release_date").alias("fixed"))
        index = index.join(fixed, entry, "left").withColumn("entry_release_date", F.coalesce("fixed", "entry_release_date")).drop("fixed")
    if splits is not None:
        index = with_splits(index, splits, wanted=wanted, key=key)
    return select_where(index, columns=columns, filters=filters, denied=denied)


def query_protein_similarity(
    scores: DataFrame, *, search_db: str = "holo", columns: Sequence[str] | None = None, filters: Sequence | None = None
) -> DataFrame:
    """Protein similarity against one kind of target. Filters must be given; one on the kind itself is left out."""
    if search_db not in schemas.SEARCH_KINDS:
        raise ValueError(f"search_db is one of {schemas.SEARCH_KINDS}, not {search_db!r}")
    rest = [f for f in filters or [] if isinstance(f, list) or f[0] != "search_db"]
    if not rest:
        raise ValueError("protein similarity is read with filters only")
    scores = scores.where(F.col("search_db") == search_db)
    return select_where(scores, columns=[c for c in columns or [] if c != "search_db"], filters=rest, schema=schemas.PROTEIN_SIMILARITY)


def query_ligand_similarity(scores: DataFrame, *, columns: Sequence[str] | None = None, filters: Sequence | None = None) -> DataFrame:
    return select_where(scores, columns=columns, filters=filters, schema=schemas.LIGAND_SIMILARITY, need_filters=True)


def query_clusters(clusters: DataFrame, *, columns: Sequence[str] | None = None, filters: Sequence | None = None) -> DataFrame:
    """Cluster labels. A partition folder gives ``directed`` as text, which is made a truth value."""
    if "directed" in clusters.columns:
        clusters = clusters.withColumn("directed", F.col("directed").cast("string").eqNullSafe("true") | F.col("directed").cast("string").eqNullSafe("True"))
    return select_where(clusters, columns=columns, filters=filters, schema=schemas.CLUSTERS)


def query_links(spark: SparkSession, path: str, *, columns: Sequence[str] | None = None, filters: Sequence | None = None) -> DataFrame:
    """Links, of a folder with ``kind=`` partitions or of files named ``<kind>_links``; nothing is deleted or moved."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if "kind" not in df.columns:
        df = df.withColumn("kind", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)_links", 1))
    return select_where(df, columns=columns, filters=filters)


def shard_of(kind: str, ident: str) -> str:
    """The two-character shard of a system id or of an entry id; a malformed one is a ValueError."""
    if len(ident) < 4:
        raise ValueError(f"too short for a {kind} id: {ident!r}")
    return ident[1:3] if kind == "system" else ident[-3:-1]


def shards(*, system_ids: Sequence[str] = (), entry_ids: Sequence[str] = (), codes: Sequence[str] = ()) -> list[str]:
    """The shards to read: of system ids if there are any, else of entry ids, else the codes themselves."""
    if system_ids:
        return sorted({shard_of("system", i) for i in system_ids})
    if entry_ids:
        return sorted({shard_of("entry", i) for i in entry_ids})
    return sorted(set(codes))


def missing_work(wanted: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``wanted`` that the sink doesn't have yet."""
    return wanted.join(done.select(*([key] if isinstance(key, str) else key)).distinct(), key, "left_anti")
