"""Similarity scores of systems from chain alignments: mapping, pair scores, roll-up, pockets and interactions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn import schemas
from cairn.functions import scalars
from cairn.operators.similarity import aligned_positions, greedy_mapping

#: Endings and beginnings that the structure aligner adds to ids. Fixed values.
MARKS = {"holo": r"_xyz-enrich\.cif(\.gz)?|^pdb_0000", "apo": r"_xyz-enrich\.cif(\.gz)?|^pdb_0000", "pred": r"-F1-model_v4(\.cif)?|^AF-"}
#: Residues that stand for others where substitutions are scored. Fixed values.
STAND_INS = ("XBJZUO", "ADLECK")
STRUCTURE, SEQUENCE = "foldseek", "mmseqs"
PAIR_SCORES = ("qcov", "fident", "seqsim", "fident_qcov", "seqsim_qcov", "lddt", "lddt_qcov")
#: The score that maps chains, by source.
MAPPER = {STRUCTURE: "lddt_qcov", SEQUENCE: "fident_qcov"}
#: Scores below these aren't kept; the others' least is 0 as well.
LEAST = {"pli_qcov": 0, "pocket_qcov": 0, "pli_unique_qcov": 0}


def read_substitutions(lines: Iterable[str]) -> dict[tuple[str, str], int]:
    """A substitution matrix in the usual text format: comments, a line of residues, a line of scores for each."""
    rows = [line.split() for line in lines if line.strip() and not line.startswith("#")]
    return {(row[0], b): int(s) for row in rows[1:] for b, s in zip(rows[0], row[1:])}


def sequence_similarity(query: Column, target: Column, substitutions: dict[tuple[str, str], int], *, least: float = 0.2) -> Column:
    """Share of aligned pairs whose substitution score, none below 0, is over ``least`` of the larger score with itself.

    Columns with a gap don't count; without any other column the result is null. The pairs that count are found once, so
    that rows only look them up.
    """
    similar = [a + b for (a, b), s in substitutions.items() if max(0, s) / max(substitutions[a, a], substitutions[b, b], 1) > least]
    table = F.array(*[F.lit(p) for p in sorted(similar)])
    q, t = (F.split(F.translate(F.upper(c), *STAND_INS), "") for c in (query, target))
    pairs = F.filter(F.zip_with(q, t, lambda a, b: F.concat(a, b)), lambda p: ~F.contains(p, F.lit("-")) & (F.length(p) == 2))
    return F.when(F.size(pairs) > 0, F.size(F.filter(pairs, lambda p: F.array_contains(table, p))) / F.size(pairs))


def mapped_alignments(
    alignments: DataFrame, chains: DataFrame, *, aligner: str, search_db: str, substitutions: dict[tuple[str, str], int] | None = None
) -> DataFrame:
    """Alignments by entry and chain: ids without their marks, author chains as chains of the entry, and the pair scores.

    ``alignments`` has query, target, qcov, fident, qstart, tstart, qaln, taln and, of structures, lddt and lddtfull (by
    aligned column, with commas); ``chains`` pdb_id, auth_id, asym_id. Alignments of chains that aren't known are left
    out; predicted targets have the one chain A. Without ``substitutions`` a column seqsim is taken as it is.
    """
    ids = [F.col(c) if aligner == SEQUENCE else F.regexp_replace(c, MARKS["holo" if c == "query" else search_db], "") for c in ("query", "target")]
    rows = alignments.withColumns({"query": ids[0], "target": ids[1], "qaln": F.upper("qaln"), "taln": F.upper("taln")})
    if substitutions is not None:
        rows = rows.withColumn("seqsim", sequence_similarity(F.col("qaln"), F.col("taln"), substitutions))
    known = chains.select("pdb_id", "auth_id", "asym_id").distinct()
    for side in ("query", "target"):
        parts = F.split(side, "_")
        rows = rows.withColumns({f"{side}_entry": F.get(parts, 0), "auth": F.get(parts, 1)})
        if side == "target" and search_db == "pred":
            rows = rows.withColumn("target_chain", F.lit("A")).drop("auth")
            continue
        named = known.select(F.col("pdb_id").alias(f"{side}_entry"), F.col("auth_id").alias("auth"), F.col("asym_id").alias(f"{side}_chain"))
        rows = rows.join(named, [f"{side}_entry", "auth"]).drop("auth")
    rows = rows.withColumns({"seqsim_qcov": F.col("seqsim") * F.col("qcov"), "fident_qcov": F.col("fident") * F.col("qcov"), "source": F.lit(aligner)})
    if aligner == STRUCTURE:
        return rows.withColumn("lddt_qcov", F.col("lddt") * F.col("qcov"))
    return rows.withColumns({"lddt": F.lit(None).cast("double"), "lddt_qcov": F.lit(None).cast("double"), "lddtfull": F.lit(None).cast("string")})


def aligned_residues(mapped: DataFrame, numbers: DataFrame) -> DataFrame:
    """Aligned residue pairs by their numbers: keys of the alignment, source, query_pos, target_pos, same (0/1), lddt.

    Positions count residues from 1; ``numbers`` has pdb_id, asym_id, index (from 0) and number. A pair whose query residue
    isn't numbered is left out; one whose target isn't keeps a null there.
    """
    keys = ["query_entry", "target_entry", "query_chain", "target_chain", "source"]
    rows = aligned_positions(mapped, keys=[*keys, "lddtfull"], query="qaln", target="taln", query_start="qstart", target_start="tstart")
    rows = rows.withColumn("column", F.row_number().over(_in_order(keys))).withColumn("lddt", F.get(F.split("lddtfull", ","), F.col("column") - 1).try_cast("double"))
    for side, how in (("query", "inner"), ("target", "left")):
        at = numbers.select(F.col("pdb_id").alias(f"{side}_entry"), F.col("asym_id").alias(f"{side}_chain"), (F.col("index") + 1).alias(f"{side}_pos"), F.col("number").alias(f"{side}_number"))
        rows = rows.join(at, [f"{side}_entry", f"{side}_chain", f"{side}_pos"], how)
    same = (F.col("query_residue") == F.col("target_residue")).cast("int")
    return rows.select(*keys, F.col("query_number").alias("query_pos"), F.col("target_number").alias("target_pos"), same.alias("same"), F.coalesce("lddt", F.lit(0.0)).alias("lddt"))


def _in_order(keys: list[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy("query_pos", "target_pos")


def chain_pairs(mapped: DataFrame, system_chains: DataFrame, *, search_db: str = "holo", holo_chains: DataFrame | None = None) -> DataFrame:
    """Scores of chain pairs of systems: query_system, target_system, query_instance, target_instance, length, source, and the scores.

    ``system_chains`` has system_id, pdb_id, instance (as ``1.A``), asym_id, length, place (of the chain in its system).
    Against ``holo`` targets are systems other than the query itself. Against ``apo`` and ``pred`` they are single chains
    ``entry_chain``, for the first chain of the query only, and chains of ``holo_chains`` (pdb_id, asym_id) are none.
    """
    scores = [c for c in PAIR_SCORES]
    q = system_chains.select(
        F.col("system_id").alias("query_system"), F.col("pdb_id").alias("query_entry"), F.col("asym_id").alias("query_chain"), F.col("instance").alias("query_instance"), "length", "place"
    )
    rows = mapped.select("query_entry", "target_entry", "query_chain", "target_chain", "source", *scores).join(q, ["query_entry", "query_chain"])
    if search_db == "holo":
        t = system_chains.select(F.col("system_id").alias("target_system"), F.col("pdb_id").alias("target_entry"), F.col("asym_id").alias("target_chain"), F.col("instance").alias("target_instance"))
        rows = rows.join(t, ["target_entry", "target_chain"]).where("query_system <> target_system")
    else:
        rows = rows.where("place = 0")
        if holo_chains is not None:
            held = holo_chains.select(F.col("pdb_id").alias("target_entry"), F.col("asym_id").alias("target_chain")).distinct()
            rows = rows.join(held, ["target_entry", "target_chain"], "left_anti")
        rows = rows.withColumns({"target_system": F.concat_ws("_", "target_entry", "target_chain"), "target_instance": F.concat(F.lit("0."), "target_chain")})
    return rows.select("query_system", "target_system", "query_entry", "target_entry", "query_chain", "target_chain", "query_instance", "target_instance", "length", "source", *scores)


def chain_mapping(pairs: DataFrame) -> DataFrame:
    """One-to-one chain mapping by system pair: query_system, target_system, query_instance, target_instance, mapper.

    Chains are mapped by the structure score where any chain of the two has one, else by the sequence score.
    """
    keys = ["query_system", "target_system"]
    scored = pairs.withColumn("structure", (F.col("source") == STRUCTURE).cast("int"))
    use = scored.groupBy(*keys).agg(F.max("structure").alias("by structure"))
    rows = scored.join(use, keys).where(F.col("structure") == F.col("by structure"))
    score = F.when(F.col("structure") == 1, F.col(MAPPER[STRUCTURE])).otherwise(F.col(MAPPER[SEQUENCE]))
    chosen = rows.select(*keys, "query_instance", "target_instance", score.alias("score"))
    found = greedy_mapping(chosen, keys=keys, left="query_instance", right="target_instance", score="score")
    named = use.select(*keys, F.when(F.col("by structure") == 1, STRUCTURE).otherwise(SEQUENCE).alias("mapper"))
    return found.drop("score").join(named, keys)


def protein_scores(pairs: DataFrame, mapping: DataFrame, lengths: DataFrame) -> DataFrame:
    """Protein scores by system pair and source, long: query_system, target_system, source, metric, score, mapping.

    ``_max`` and ``_weighted_max`` (the score of the pair with the largest score × length, then score) are over all chain pairs,
    ``_weighted_sum`` over the mapping, divided by the length of the query system (``lengths``: query_system, size).
    """
    keys = ["query_system", "target_system"]
    pair = F.when(F.col("target_instance") == "", F.col("query_instance")).otherwise(F.concat_ws(":", "query_instance", "target_instance"))
    long = pairs.select(
        *keys, "query_instance", "target_instance", "length", "source", pair.alias("pair"),
        F.inline(F.array(*[F.struct(F.lit(f"protein_{s}").alias("base"), F.col(s).alias("score")) for s in PAIR_SCORES])),
    ).where("score is not null")
    by = [*keys, "source", "base"]
    weight = F.col("score") * F.col("length")
    order = lambda c: F.struct((-c).alias("w"), (-F.col("score")).alias("s"), F.col("pair").alias("p"))
    top = long.where("score > 0").groupBy(*by).agg(
        F.min_by(F.struct(F.lit("max").alias("how"), "score", F.col("pair").alias("mapping")), order(F.col("score"))).alias("m"),
        F.min_by(F.struct(F.lit("weighted_max").alias("how"), "score", F.col("pair").alias("mapping")), order(weight)).alias("w"),
    )
    top = top.select(*by, F.inline(F.array("m", "w")))
    chosen = long.join(mapping.select(*keys, "query_instance", "target_instance"), [*keys, "query_instance", "target_instance"]).join(lengths, "query_system")
    sums = chosen.groupBy(*by).agg(F.lit("weighted_sum").alias("how"), (F.sum(weight) / F.max("size")).alias("score"), F.array_join(F.array_sort(F.collect_list("pair")), ";").alias("mapping"))
    found = top.union(sums.select(*by, "how", "score", "mapping"))
    return found.select(*keys, "source", F.concat_ws("_", "base", "how").alias("metric"), "score", "mapping")


def pocket_pli_scores(residues: DataFrame, pockets: DataFrame, interactions: DataFrame, *, count_values: bool = False) -> DataFrame:
    """Pocket and interaction scores by system pair and source, long: query_system, target_system, source, metric, score.

    ``residues`` has the system pair, source, query_instance, target_instance, query_pos, target_pos, same and lddt of mapped
    chains; ``pockets`` system_id, instance, residue; ``interactions`` those and kind, one row by interaction. Shares are of
    the query's pocket residues, interactions, and kinds of interactions by residue. ``count_values`` compares how
    often kinds occur in place of the kinds themselves for ``pli_unique_qcov``, as published scores do.
    """
    keys = ["query_system", "target_system", "source"]

    def side(table: DataFrame, name: str, *more: str) -> DataFrame:
        return table.select(F.col("system_id").alias(f"{name}_system"), F.col("instance").alias(f"{name}_instance"), F.col("residue").alias(f"{name}_pos"), *more).distinct()

    size = pockets.distinct().groupBy(F.col("system_id").alias("query_system")).agg(F.count(F.lit(1)).alias("n"))
    in_pocket = residues.join(side(pockets, "query"), ["query_system", "query_instance", "query_pos"])
    both = side(pockets, "target").withColumn("both", F.lit(1))
    rows = in_pocket.join(both, ["target_system", "target_instance", "target_pos"], "left").join(size, "query_system").withColumn("both", F.coalesce("both", F.lit(0)))
    same, lddt, shared = F.col("same").cast("double"), F.col("lddt"), F.col("both")
    values = {"pocket_lddt": lddt, "pocket_fident": same, "pocket_qcov": shared, "pocket_lddt_qcov": lddt * shared, "pocket_fident_qcov": same * shared}
    pocket = rows.groupBy(*keys).agg(*[(F.sum(v) / F.max("n")).alias(k) for k, v in values.items()])

    counted = interactions.groupBy("system_id", "instance", "residue", "kind").agg(F.count(F.lit(1)).alias("times"))
    totals = counted.groupBy(F.col("system_id").alias("query_system")).agg(F.sum("times").alias("total"), F.count(F.lit(1)).alias("kinds"))
    met = rows.where("both = 1").select(*keys, "query_instance", "target_instance", "query_pos", "target_pos")
    q = counted.select(*[F.col(a).alias(b) for a, b in (("system_id", "query_system"), ("instance", "query_instance"), ("residue", "query_pos"), ("times", "nq"))], "kind")
    t = counted.select(*[F.col(a).alias(b) for a, b in (("system_id", "target_system"), ("instance", "target_instance"), ("residue", "target_pos"), ("times", "nt"))], "kind")
    left = met.join(q, ["query_system", "query_instance", "query_pos"])
    pairs = left.join(t, ["target_system", "target_instance", "target_pos", "kind"])
    shares = pairs.groupBy(*keys).agg(F.sum(F.least("nq", "nt")).alias("common"), F.count(F.lit(1)).alias("same kinds"))
    if count_values:
        alike = left.join(t.withColumnsRenamed({"kind": "other", "nt": "nq"}), ["target_system", "target_instance", "target_pos", "nq"])
        alike = alike.select(*keys, "query_instance", "query_pos", "nq").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("same kinds"))
        shares = shares.drop("same kinds").join(alike, keys, "left")
    pli = shares.join(totals, "query_system").select(*keys, (F.col("common") / F.col("total")).alias("pli_qcov"), (F.col("same kinds") / F.col("kinds")).alias("pli_unique_qcov"))

    def long(wide: DataFrame, names: Iterable[str]) -> DataFrame:
        rows = wide.select(*keys, F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("score")) for n in names])))
        return rows.where("score > 0")

    return long(pocket, values).union(long(pli, ("pli_qcov", "pli_unique_qcov")))


def combined(scores: DataFrame, mapping: DataFrame, *, search_db: str, least: dict[str, float] | None = None) -> DataFrame:
    """Rows of the similarity table: the better of both sources by metric, in percent, with the mappings.

    ``scores`` is the union of protein, pocket and interaction scores, with ``mapping`` null for the latter two; a source
    that lacks a score counts as 0. ``mapping`` is :func:`chain_mapping`.
    """
    keys = ["query_system", "target_system"]
    wide = scores.groupBy(*keys, "metric").agg(
        *[F.max(F.when(F.col("source") == s, F.col("score"))).alias(s) for s in (STRUCTURE, SEQUENCE)],
        *[F.max(F.when(F.col("source") == s, F.col("mapping"))).alias(f"{s} mapping") for s in (STRUCTURE, SEQUENCE)],
    )
    value, source = scalars.best_of({s: F.coalesce(s, F.lit(0.0)) for s in (STRUCTURE, SEQUENCE)})
    rows = wide.select(*keys, "metric", value.alias("value"), source.alias("source"), F.when(source == SEQUENCE, F.col(f"{SEQUENCE} mapping")).otherwise(F.col(f"{STRUCTURE} mapping")).alias("mapping"))
    limits = {**LEAST, **(least or {})}
    floor = F.lit(0.0)
    for name, limit in limits.items():
        floor = F.when(F.col("metric") == name, float(limit)).otherwise(floor)
    chains = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "query_instance", "target_instance"))), ";")
    mapped = mapping.groupBy(*keys).agg(chains.alias("protein_mapping"), F.max("mapper").alias("protein_mapper"))
    found = rows.where((F.col("value") >= floor) & F.col("metric").isin(*schemas.METRICS)).join(mapped, keys, "left")
    return found.select(
        *keys, "protein_mapping", "mapping", "protein_mapper", "source", "metric",
        scalars.half_even_percent(F.col("value")).alias("similarity"), F.lit(search_db).alias("search_db"),
    )


def score_systems(
    mapped: DataFrame,
    system_chains: DataFrame,
    numbers: DataFrame,
    pockets: DataFrame,
    interactions: DataFrame,
    *,
    search_db: str = "holo",
    holo_chains: DataFrame | None = None,
    count_values: bool = False,
) -> DataFrame:
    """The similarity table of all query systems of the mapped alignments against one kind of target. Another kind is a ValueError."""
    if search_db not in schemas.SEARCH_KINDS:
        raise ValueError(f"search_db is one of {schemas.SEARCH_KINDS}, not {search_db!r}")
    pairs = chain_pairs(mapped, system_chains, search_db=search_db, holo_chains=holo_chains)
    mapping = chain_mapping(pairs)
    lengths = system_chains.groupBy(F.col("system_id").alias("query_system")).agg(F.sum("length").alias("size"))
    protein = protein_scores(pairs, mapping, lengths)
    chosen = pairs.join(mapping.drop("mapper"), ["query_system", "target_system", "query_instance", "target_instance"]).drop(*PAIR_SCORES)
    residues = chosen.join(aligned_residues(mapped, numbers), ["query_entry", "target_entry", "query_chain", "target_chain", "source"])
    pocket = pocket_pli_scores(residues, pockets, interactions, count_values=count_values).withColumn("mapping", F.lit(None).cast("string"))
    return combined(protein.unionByName(pocket), mapping, search_db=search_db)
