"""Writers of the data model's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn import schemas


def write_scores(scores: DataFrame, path: str) -> None:
    """Similarity rows by metric, so that a metric's scan prunes the others. A file by metric and score would be too small."""
    columns = [F.col(f.name).cast(f.dataType) for f in schemas.PROTEIN_SIMILARITY if f.name in scores.columns]
    scores.select(*columns).repartition("metric").write.mode("overwrite").partitionBy("metric").parquet(path)


def compact(df: DataFrame, path: str, *, key: str, files: int, rows: int = 500_000) -> None:
    """Rewrite as few, ordered files of bounded size."""
    df.repartition(files, key).sortWithinPartitions(key).write.option("maxRecordsPerFile", rows).mode("overwrite").parquet(path)


def write_clusters(labels: DataFrame, path: str, *, skip_existing: bool = False) -> bool:
    """Cluster labels in partition folders; False where they were there and were to be left."""
    spark: SparkSession = labels.sparkSession
    if skip_existing:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            return False
    labels.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cluster", "directed", "metric", "threshold").parquet(path)
    return True


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; columns that one lacks are null there."""
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    return found


def consolidate_links(links: DataFrame, scores: DataFrame, key: tuple[str, str] = ("reference_system_id", "id")) -> DataFrame:
    """Links with their scores; columns that both have are the scores'."""
    left = links.drop(*[c for c in scores.columns if c in links.columns and c not in key])
    return left.join(scores, list(key))


def write_dictionary(df: DataFrame, path: str) -> None:
    """Data dictionary of a table, tab-separated."""
    rows = schemas.dictionary(df.schema)
    df.sparkSession.createDataFrame(rows, "Name string, Type string, Description string").coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_index(shards: list[DataFrame], path: str, *, renamed: dict[str, str] | None = None, flags: tuple[str, ...] = (), force: bool = False) -> bool:
    """Write the index of all shards; False, and nothing is written, where one with the same columns is there and ``force`` is off.

    ``flags`` become truth values, missing ones false; columns are renamed last.
    """
    index = union_all(shards)
    index = index.withColumns({f: F.coalesce(F.col(f).cast("boolean"), F.lit(False)) for f in flags if f in index.columns}).withColumnsRenamed(renamed or {})
    if not force and _exists(index.sparkSession, path) and set(index.sparkSession.read.parquet(path).columns) == set(index.columns):
        return False
    index.write.mode("overwrite").parquet(path)
    return True


def write_ligands(parts: list[DataFrame], path: str) -> None:
    """Distinct ligand rows of a batch of entries."""
    union_all(parts).distinct().write.mode("overwrite").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def moved_into_folders(spark: SparkSession, path: str) -> int:
    """Files ``threshold=N.parquet`` of an old layout become ``threshold=N/data.parquet``; how many there were."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, todo = 0, [root]
    while todo:
        for status in files.listStatus(todo.pop()):
            here = status.getPath()
            name = here.getName()
            if status.isDirectory() and not name.endswith(".parquet"):
                todo.append(here)
            elif name.startswith("threshold=") and name.endswith(".parquet"):
                folder = jvm.org.apache.hadoop.fs.Path(here.getParent(), name.removesuffix(".parquet"))
                files.mkdirs(folder)
                if not files.rename(here, jvm.org.apache.hadoop.fs.Path(folder, "data.parquet")):
                    raise OSError(f"could not move {here}")
                found += 1
    return found


def write_archives(files: DataFrame, path: str) -> DataFrame:
    """Zip archives, one by ``shard``, of rows (shard, name, content): ``path``/shard.zip; rows shard, n, bytes.

    A task writes whole archives, in the order of names, so an archive that is written again has the same bytes; it
    appears under its name when it is whole. The target is a mounted file system or a URI that pyarrow opens.
    """

    def run(batches):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs

        def close(shard, held, archive, n):
            archive.close()
            store, folder = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/{shard}.zip.part") as out:
                out.write(held.getvalue())
            store.move(f"{folder}/{shard}.zip.part", f"{folder}/{shard}.zip")
            return pd.DataFrame({"shard": [shard], "n": [n], "bytes": [len(held.getvalue())]})

        shard, held, archive, n = None, None, None, 0
        for batch in batches:
            for s, name, content in zip(batch["shard"], batch["name"], batch["content"]):
                if s != shard:
                    if archive is not None:
                        yield close(shard, held, archive, n)
                    shard, held, n = s, io.BytesIO(), 0
                    archive = zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED)
                archive.writestr(zipfile.ZipInfo(name), bytes(content))
                n += 1
        if archive is not None:
            yield close(shard, held, archive, n)

    rows = files.select("shard", "name", F.col("content").cast("binary").alias("content")).repartition("shard").sortWithinPartitions("shard", "name")
    return rows.mapInPandas(run, "shard string, n long, bytes long")


# Structure files, as text by system.


def fasta(sequences: DataFrame) -> DataFrame:
    """One FASTA text by system, of rows (system_id, chain, sequence), in the order of chains."""
    entry = F.concat(F.lit(">"), "chain", F.lit("\n"), "sequence", F.lit("\n"))
    rows = F.array_sort(F.collect_list(F.struct("chain", entry.alias("entry"))))
    return sequences.where("sequence is not null").groupBy("system_id").agg(F.array_join(F.transform(rows, lambda r: r["entry"]), "").alias("text"))


def pdb_chains(chains: DataFrame) -> DataFrame:
    """Single-letter names of a system's chains (system_id, chain): ``name``; proteins, then others, each in order. A system of more than 62 is an error of the row: name null."""
    from pyspark.sql import Window

    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    order = [F.desc("is_protein"), "chain"] if "is_protein" in chains.columns else ["chain"]
    place = F.row_number().over(Window.partitionBy("system_id").orderBy(*order))
    return chains.withColumn("name", F.when(place <= len(letters), F.substring(F.lit(letters), place, F.lit(1))))


def pdb_text(atoms: DataFrame) -> DataFrame:
    """PDB text by system of an atom table: system_id, serial, atom, residue_name, chain (one letter), residue, x, y, z, element, hetero."""
    name = F.when(F.length("element") == 1, F.concat(F.lit(" "), "atom")).otherwise(F.col("atom"))
    line = F.concat(
        F.when(F.col("hetero"), "HETATM").otherwise("ATOM  "),
        F.lpad((F.col("serial") % 100_000).cast("string"), 5, " "), F.lit(" "), F.rpad(name, 4, " "), F.lit(" "),
        F.lpad("residue_name", 3, " "), F.lit(" "), F.col("chain"), F.lpad((F.col("residue") % 10_000).cast("string"), 4, " "), F.lit("    "),
        *[F.lpad(F.format_string("%.3f", F.col(c)), 8, " ") for c in "xyz"],
        F.lit("  1.00  0.00          "), F.lpad(F.upper("element"), 2, " "), F.lit("\n"),
    )
    rows = F.array_sort(F.collect_list(F.struct("serial", line.alias("line"))))
    return atoms.groupBy("system_id").agg(F.concat(F.array_join(F.transform(rows, lambda r: r["line"]), ""), F.lit("END\n")).alias("text"))


#: Columns of an atom loop, in order. Fixed names.
CIF_ATOMS = ("group_PDB", "id", "type_symbol", "label_atom_id", "label_comp_id", "label_asym_id", "label_seq_id", "Cartn_x", "Cartn_y", "Cartn_z")


def cif_text(atoms: DataFrame) -> DataFrame:
    """mmCIF text by system of an atom table as in :func:`pdb_text`, with chains of any name."""
    values = [
        F.when(F.col("hetero"), "HETATM").otherwise("ATOM"), F.col("serial").cast("string"), F.upper("element"),
        F.when(F.contains("atom", F.lit("'")), F.concat(F.lit('"'), "atom", F.lit('"'))).otherwise(F.col("atom")),
        F.col("residue_name"), F.col("chain"), F.coalesce(F.col("residue").cast("string"), F.lit(".")), *[F.format_string("%.3f", F.col(c)) for c in "xyz"],
    ]
    rows = F.array_sort(F.collect_list(F.struct("serial", F.concat_ws(" ", *values).alias("line"))))
    head = "\nloop_\n" + "".join(f"_atom_site.{c}\n" for c in CIF_ATOMS)
    text = F.concat(F.lit("data_"), "system_id", F.lit("\n#" + head), F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), F.lit("\n#\n"))
    return atoms.groupBy("system_id").agg(rows.alias("rows")).select("system_id", text.alias("text"))


def write_texts(texts: DataFrame, name: str, path: str) -> int:
    """Write the ``text`` of each row to ``path``/system_id/name, each file whole or not at all; how many. The folder is shared."""

    def run(batches):
        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            store, folder = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
            for system, text in zip(batch["system_id"], batch["text"]):
                store.create_dir(f"{folder}/{system}", recursive=True)
                with store.open_output_stream(f"{folder}/{system}/{name}.part") as out:
                    out.write(text.encode())
                store.move(f"{folder}/{system}/{name}.part", f"{folder}/{system}/{name}")
            yield pd.DataFrame({"n": [len(batch)]})

    return texts.select("system_id", "text").mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0
