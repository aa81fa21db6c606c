"""Annotation of entries: nested documents to tables, quality, chains, domains, contacts and gaps.

An entry document holds chains and systems, a system its ligands. What belongs to one entry is worked out inside its
document, with functions on arrays and maps, so that nothing is shuffled; what meets other tables is exploded first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions import scalars
from cairn.operators.graph import connected_components
from cairn.operators.spatial import gaps, interval_join, radius_join

#: Fields of a ligand. Residue numbers are by instance and chain, as in ``1.A``; interactions are lists by residue.
LIGAND = (
    "struct<instance:int, asym_id:string, ccd_code:string, unique_ccd_code:string, smiles:string, molecular_weight:double, qed:double, "
    "num_heavy_atoms:int, num_resolved_heavy_atoms:int, num_unresolved_heavy_atoms:int, is_ion:boolean, is_artifact:boolean, is_cofactor:boolean, "
    "is_covalent:boolean, protein_chains:array<string>, neighboring_ligands:array<string>, interacting_ligands:array<string>, "
    "neighboring_residues:map<string,array<int>>, interacting_residues:map<string,array<int>>, interactions:map<string,map<int,array<string>>>, "
    "crystal_contacts:array<struct<chain:string, residue:int, atoms:array<int>>>>"
)
RESIDUE = (
    "struct<index:int, auth_number:string, rsr:double, rsrz:double, rscc:double, average_occupancy:double, average_b_factor:double, alt_count:int, "
    "atom_count:int, heavy_atom_count:int, num_unresolved_heavy_atoms:int, unknown_residue:boolean, outliers:array<string>>"
)
CHAIN = (
    "struct<asym_id:string, auth_id:string, entity_id:string, chain_type:string, length:int, holo:boolean, "
    f"mappings:map<string,map<string,array<struct<start:int,end:int>>>>, residues:map<int,{RESIDUE}>>"
)
#: Schema of an entry document.
ENTRY = (
    "struct<pdb_id:string, release_date:string, oligomeric_state:string, determination_method:string, keywords:string, pH:string, resolution:double, "
    "validation:struct<resolution:double, r:double, rfree:double, r_minus_rfree:double>, "
    f"chains:map<string,{CHAIN}>, systems:array<struct<biounit_id:string, ligands:array<{LIGAND}>>>>"
)
#: The same as JSON holds it: keys are texts.
ENTRY_JSON = ENTRY.replace("map<int,", "map<string,")
MOST_CHAINS = 5


@dataclass(frozen=True)
class QualityCriteria:
    """Limits that an entry and a system must keep. The default values are fixed by the published procedure."""

    max_entry_resolution: float = 3.5
    max_entry_r: float = 0.4
    max_entry_rfree: float = 0.45
    max_entry_r_minus_rfree: float = 0.05
    ligand_max_num_unresolved_heavy_atoms: int = 0
    ligand_max_alt_count: int = 1
    ligand_min_average_occupancy: float = 0.8
    ligand_min_average_rscc: float = 0.8
    ligand_max_average_rsr: float = 0.3
    ligand_max_percent_outliers_clashes: float = 0
    ligand_max_fraction_atoms_with_crystal_contacts: float = 0
    pocket_max_num_unresolved_heavy_atoms: int = 0
    pocket_max_alt_count: int = 1
    pocket_min_average_occupancy: float = 0.8
    pocket_min_average_rscc: float = 0.8
    pocket_max_average_rsr: float = 0.3
    pocket_max_percent_outliers_clashes: float = 100


def parsed(text: Column) -> Column:
    """An entry document of its JSON text; what isn't one is null, and fields that it lacks are."""
    return F.from_json(text, ENTRY_JSON).cast(ENTRY)


def proper(ligand: Column) -> Column:
    """Neither ion nor artifact."""
    return ~F.coalesce(ligand["is_ion"], F.lit(False)) & ~F.coalesce(ligand["is_artifact"], F.lit(False))


def instance_chain(ligand: Column) -> Column:
    return F.concat_ws(".", ligand["instance"].cast("string"), ligand["asym_id"])


def ligand_id(pdb_id: Column, biounit: Column, ligand: Column) -> Column:
    return F.concat_ws("__", pdb_id, biounit, instance_chain(ligand))


def sorted_chains(ligands: Column) -> Column:
    """Interacting protein chains of all ligands, in order."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(ligands, lambda x: F.coalesce(x["protein_chains"], F.array().cast("array<string>"))))))


def system_id(pdb_id: Column, biounit: Column, ligands: Column) -> Column:
    """Entry, biounit, protein chains and ligand chains."""
    return F.concat_ws("__", pdb_id, biounit, F.array_join(sorted_chains(ligands), "_"), F.array_join(F.transform(ligands, instance_chain), "_"))


def system_type(ligands: Column) -> Column:
    """``holo`` with a proper ligand, else ``ion`` with an ion, else ``artifact``."""
    ion = F.exists(ligands, lambda x: F.coalesce(x["is_ion"], F.lit(False)))
    return F.when(F.exists(ligands, proper), "holo").when(ion, "ion").otherwise("artifact")


def pocket(ligand: Column) -> Column:
    """Residues of a ligand's pocket by chain, each ``neighboring`` or ``interacting``; interacting ones are the latter."""

    def marked(residues: Column, kind: str) -> Column:
        return F.transform_values(residues, lambda k, v: F.map_from_arrays(F.array_distinct(v), F.array_repeat(F.lit(kind), F.size(F.array_distinct(v)))))

    none = F.create_map().cast("map<string,map<int,string>>")
    near, inter = (F.coalesce(marked(ligand[f"{k}_residues"], k), none) for k in ("neighboring", "interacting"))
    empty = F.create_map().cast("map<int,string>")
    return F.map_zip_with(near, inter, lambda c, a, b: scalars.merge_maps(F.coalesce(a, empty), F.coalesce(b, empty)))


def num_interactions(ligand: Column, *, unique: bool = False) -> Column:
    """Interactions of a ligand; ``unique`` counts each kind once by residue."""
    by_residue = F.flatten(F.transform(F.map_values(ligand["interactions"]), F.map_values))
    sizes = F.transform(by_residue, lambda x: F.size(F.array_distinct(x) if unique else x))
    return F.coalesce(F.aggregate(sizes, F.lit(0), lambda s, n: s + n), F.lit(0))


def interaction_labels(ligand: Column) -> Column:
    """``chain_residue_interaction`` of every interaction."""
    by_chain = F.transform(
        F.map_entries(ligand["interactions"]),
        lambda c: F.flatten(F.transform(F.map_entries(c["value"]), lambda r: F.transform(r["value"], lambda i: F.concat_ws("_", c["key"], r["key"].cast("string"), i)))),
    )
    return F.coalesce(F.flatten(by_chain), F.array().cast("array<string>"))


def system_interactions(ligands: Column) -> Column:
    """All interactions of the ligands that aren't artifacts, as an array of (chain, residue, kind)."""
    shape = "array<struct<chain:string,residue:int,kind:string>>"

    def of(ligand: Column) -> Column:
        rows = F.transform(
            F.map_entries(ligand["interactions"]),
            lambda c: F.flatten(
                F.transform(
                    F.map_entries(c["value"]),
                    lambda r: F.transform(r["value"], lambda i: F.struct(c["key"].alias("chain"), r["key"].alias("residue"), i.alias("kind"))),
                )
            ),
        )
        return F.coalesce(F.flatten(rows), F.array().cast(shape))

    kept = F.filter(ligands, lambda x: ~F.coalesce(x["is_artifact"], F.lit(False)))
    return F.flatten(F.transform(kept, of)).cast(shape)


def crystal_contacts(ligand: Column, receptors: Column) -> Column:
    """Contacts with symmetry mates whose chain is among ``receptors`` and whose residue isn't in the pocket."""
    near = F.flatten(F.transform(F.map_entries(pocket(ligand)), lambda c: F.transform(F.map_keys(c["value"]), lambda r: F.concat_ws(":", F.element_at(F.split(c["key"], r"\."), -1), r.cast("string")))))
    outside = F.filter(
        ligand["crystal_contacts"],
        lambda x: F.array_contains(receptors, x["chain"]) & ~F.array_contains(near, F.concat_ws(":", x["chain"], x["residue"].cast("string"))),
    )
    return F.coalesce(outside, F.array().cast("array<struct<chain:string,residue:int,atoms:array<int>>>"))


def contact_atoms(contacts: Column) -> Column:
    """Distinct atoms in contact."""
    return F.size(F.array_distinct(F.flatten(F.transform(contacts, lambda x: x["atoms"]))))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, n: s + n)


def systems(entries: DataFrame) -> DataFrame:
    """One row by system of entry documents (column ``entry``): ids, type, chains, and the numbers that the index carries.

    Sums of heavy atoms are null where one is null; the largest weight and QED count a missing one as -1, and a system
    without proper ligands as -1. Systems without a protein chain are left out.
    """
    rows = entries.select(F.col("entry.pdb_id").alias("entry_pdb_id"), F.col("entry.chains").alias("chains"), F.explode("entry.systems").alias("s"))
    ligands, fit = F.col("s.ligands"), F.filter("s.ligands", proper)
    pockets = F.flatten(F.transform(ligands, lambda x: F.flatten(F.transform(F.map_entries(pocket(x)), lambda c: F.transform(F.map_keys(c["value"]), lambda r: F.struct(c["key"].alias("chain"), r.alias("residue")))))))
    receptors = F.array_except(F.map_keys("chains"), F.transform(ligands, lambda x: x["asym_id"]))
    contacts = F.transform(ligands, lambda x: crystal_contacts(x, receptors))
    heavy = scalars.strict_sum(F.transform(ligands, lambda x: x["num_heavy_atoms"]))
    touched = _sum(F.transform(contacts, lambda x: contact_atoms(x).cast("long")))
    found = rows.select(
        "entry_pdb_id",
        F.col("s.biounit_id").alias("system_biounit_id"),
        system_id(F.col("entry_pdb_id"), F.col("s.biounit_id"), ligands).alias("system_id"),
        system_type(ligands).alias("system_type"),
        sorted_chains(ligands).alias("system_protein_chains"),
        F.transform(ligands, instance_chain).alias("system_ligand_chains"),
        F.size(sorted_chains(ligands)).alias("system_num_protein_chains"),
        F.size(sorted_chains(fit)).alias("system_proper_num_protein_chains"),
        F.size(ligands).alias("system_num_ligand_chains"),
        F.size(fit).alias("system_proper_num_ligand_chains"),
        _sum(F.transform(ligands, lambda x: num_interactions(x).cast("long"))).alias("system_num_interactions"),
        _sum(F.transform(fit, lambda x: num_interactions(x).cast("long"))).alias("system_proper_num_interactions"),
        _sum(F.transform(ligands, lambda x: num_interactions(x, unique=True).cast("long"))).alias("system_num_unique_interactions"),
        F.size(F.array_distinct(pockets)).alias("system_num_pocket_residues"),
        heavy.cast("long").alias("system_num_heavy_atoms"),
        scalars.strict_sum(F.transform(ligands, lambda x: x["num_resolved_heavy_atoms"])).cast("long").alias("system_num_resolved_heavy_atoms"),
        scalars.strict_sum(F.transform(ligands, lambda x: x["num_unresolved_heavy_atoms"])).cast("long").alias("system_num_unresolved_heavy_atoms"),
        _sum(F.transform(ligands, lambda x: F.coalesce(x["is_covalent"], F.lit(False)).cast("long"))).alias("system_num_covalent_ligands"),
        scalars.max_or(F.transform(ligands, lambda x: x["qed"])).alias("system_ligand_max_qed"),
        scalars.max_or(F.transform(ligands, lambda x: x["molecular_weight"])).alias("system_ligand_max_molecular_weight"),
        F.coalesce(scalars.max_or(F.transform(fit, lambda x: x["molecular_weight"])), F.lit(-1.0)).alias("system_proper_ligand_max_molecular_weight"),
        F.exists(ligands, lambda x: F.coalesce(x["is_cofactor"], F.lit(False))).alias("system_ligand_has_cofactor"),
        F.size(F.array_distinct(F.flatten(F.transform(contacts, lambda c: F.transform(c, lambda x: F.struct(x["chain"], x["residue"])))))).alias("system_num_crystal_contacted_residues"),
        touched.alias("system_num_atoms_with_crystal_contacts"),
        F.try_divide(touched.cast("double"), heavy).alias("system_fraction_atoms_with_crystal_contacts"),
    )
    return found.where("system_num_protein_chains > 0")


def ligands(entries: DataFrame) -> DataFrame:
    """One row by ligand: ids and what the index carries of it."""
    rows = entries.select(F.col("entry.pdb_id").alias("entry_pdb_id"), F.explode("entry.systems").alias("s"))
    rows = rows.withColumn("system_id", system_id(F.col("entry_pdb_id"), F.col("s.biounit_id"), F.col("s.ligands")))
    rows = rows.select("entry_pdb_id", "system_id", F.col("s.biounit_id").alias("biounit"), F.explode("s.ligands").alias("x"))
    x = F.col("x")
    return rows.select(
        "system_id",
        ligand_id(F.col("entry_pdb_id"), F.col("biounit"), x).alias("ligand_id"),
        F.col("x.instance").alias("ligand_instance"),
        F.col("x.asym_id").alias("ligand_asym_id"),
        F.col("x.ccd_code").alias("ligand_ccd_code"),
        F.col("x.unique_ccd_code").alias("ligand_unique_ccd_code"),
        F.col("x.smiles").alias("ligand_rdkit_canonical_smiles"),
        F.col("x.molecular_weight").alias("ligand_molecular_weight"),
        F.col("x.is_ion").alias("ligand_is_ion"),
        F.col("x.is_artifact").alias("ligand_is_artifact"),
        F.col("x.is_cofactor").alias("ligand_is_cofactor"),
        proper(x).alias("ligand_is_proper"),
        num_interactions(x).alias("ligand_num_interactions"),
        num_interactions(x, unique=True).alias("ligand_num_unique_interactions"),
        scalars.total_size(F.transform_values(pocket(x), lambda k, v: F.map_keys(v))).alias("ligand_num_pocket_residues"),
        interaction_labels(x).alias("ligand_interactions"),
        scalars.residue_labels(F.col("x.interacting_residues")).alias("ligand_interacting_residues"),
        scalars.residue_labels(F.col("x.neighboring_residues")).alias("ligand_neighboring_residues"),
    )


def flatten(entries: DataFrame, criteria: QualityCriteria = QualityCriteria()) -> DataFrame:
    """The index of entry documents: a row by ligand, with the columns of its system and entry."""
    top = entries.select(
        F.col("entry.pdb_id").alias("entry_pdb_id"),
        *[F.col(f"entry.{c}").alias(f"entry_{c}") for c in ("release_date", "oligomeric_state", "determination_method", "keywords", "pH", "resolution")],
        entry_quality(F.col("entry.validation"), criteria).alias("entry_pass_validation_criteria"),
    )
    return ligands(entries).join(systems(entries), "system_id").join(top, "entry_pdb_id")


def pruned(entries: DataFrame, *, most_protein_chains: int = MOST_CHAINS, most_ligand_chains: int = MOST_CHAINS, count_interacting: bool = False) -> DataFrame:
    """Entry documents with only their holo systems of few chains; documents stay, with fewer systems.

    ``count_interacting`` counts the protein chains that have interacting residues, where else they are those that the
    ligands name.
    """

    def chains(s: Column) -> Column:
        if not count_interacting:
            return F.size(sorted_chains(s["ligands"]))
        return F.size(F.array_distinct(F.flatten(F.transform(s["ligands"], lambda x: F.map_keys(x["interacting_residues"])))))

    kept = F.filter(
        "entry.systems",
        lambda s: (system_type(s["ligands"]) == "holo") & (chains(s) <= most_protein_chains) & (F.size(s["ligands"]) <= most_ligand_chains),
    )
    return entries.withColumn("entry", F.col("entry").withField("systems", kept))


def only_pocket_residues(entries: DataFrame) -> DataFrame:
    """Entry documents whose chains hold the residues of some ligand's pocket only."""
    everywhere = F.flatten(F.transform("entry.systems", lambda s: F.flatten(F.transform(s["ligands"], lambda x: F.map_entries(pocket(x))))))
    named = F.transform(everywhere, lambda e: F.struct(F.element_at(F.split(e["key"], r"\."), -1).alias("chain"), F.map_keys(e["value"]).alias("residues")))

    def of(chain: Column) -> Column:
        return F.flatten(F.transform(F.filter(named, lambda e: e["chain"] == chain), lambda e: e["residues"]))

    chains = F.transform_values("entry.chains", lambda k, c: c.withField("residues", F.map_filter(c["residues"], lambda r, v: F.array_contains(of(k), r))))
    return entries.withColumn("entry", F.col("entry").withField("chains", chains))


def label_chains(entries: DataFrame) -> DataFrame:
    """Entry documents whose chains are marked: in a holo system ``holo``; neither in one nor a ligand, not; else as they are."""
    holo = F.filter("entry.systems", lambda s: system_type(s["ligands"]) == "holo")
    holo = F.flatten(F.transform(holo, lambda s: F.transform(sorted_chains(s["ligands"]), lambda c: F.element_at(F.split(c, r"\."), -1))))
    bound = F.flatten(F.transform("entry.systems", lambda s: F.transform(s["ligands"], lambda x: x["asym_id"])))

    def mark(k: Column, c: Column) -> Column:
        return c.withField("holo", F.when(F.array_contains(holo, k), True).when(~F.array_contains(bound, k), False).otherwise(c["holo"]))

    return entries.withColumn("entry", F.col("entry").withField("chains", F.transform_values("entry.chains", mark)))


#: How the external aligners name chains: format by kind of alignment and whether the target is predicted. Fixed formats.
ALIGNED_NAMES = {("foldseek", True): "AF-%s-F1-model_v4_A", ("foldseek", False): "pdb_0000%s_xyz-enrich.cif_%s", ("mmseqs", True): "%s", ("mmseqs", False): "%s_%s"}


def chains_for_alignment(entries: DataFrame, kind: str, aligner: str) -> DataFrame:
    """Distinct names of chains to align: column ``name``.

    ``holo``: author ids of protein chains of holo systems. ``apo``: those of chains marked not holo whose entity has no
    holo chain. ``pred``: UniProt accessions of holo chains. Documents are labelled (:func:`label_chains`).
    """
    if kind not in ("holo", "apo", "pred") or (aligner, kind == "pred") not in ALIGNED_NAMES:
        raise ValueError(f"no names of {kind!r} chains for {aligner!r}")
    pattern = ALIGNED_NAMES[aligner, kind == "pred"]
    pdb, chains = F.col("entry.pdb_id"), F.map_values("entry.chains")
    if kind == "pred":
        held = F.filter(chains, lambda c: F.coalesce(c["holo"], F.lit(False)))
        names = F.flatten(F.transform(held, lambda c: F.coalesce(F.map_keys(F.try_element_at(c["mappings"], F.lit("UniProt"))), F.array().cast("array<string>"))))
        return entries.select(F.explode(names).alias("n")).select(F.format_string(pattern, "n").alias("name")).distinct()
    if kind == "holo":
        held = F.filter("entry.systems", lambda s: system_type(s["ligands"]) == "holo")
        ids = F.flatten(F.transform(held, lambda s: F.transform(sorted_chains(s["ligands"]), lambda c: F.element_at(F.split(c, r"\."), -1))))
        names = F.transform(F.filter(ids, lambda c: F.map_contains_key("entry.chains", c)), lambda c: F.element_at("entry.chains", c)["auth_id"])
    else:
        entities = F.transform(F.filter(chains, lambda c: F.coalesce(c["holo"], F.lit(False))), lambda c: c["entity_id"])
        free = F.filter(chains, lambda c: ~F.coalesce(c["holo"], F.lit(True)) & ~F.array_contains(entities, c["entity_id"]))
        names = F.transform(free, lambda c: c["auth_id"])
    return entries.select(pdb.alias("p"), F.explode(names).alias("n")).select(F.format_string(pattern, "p", "n").alias("name")).distinct()


# Quality.


def entry_quality(validation: Column, criteria: QualityCriteria = QualityCriteria()) -> Column:
    """Whether resolution and R factors of an entry are within the criteria; a missing one isn't."""
    limits = {"resolution": criteria.max_entry_resolution, "r": criteria.max_entry_r, "rfree": criteria.max_entry_rfree, "r_minus_rfree": criteria.max_entry_r_minus_rfree}
    return reduce(and_, [F.coalesce(validation[name] <= limit, F.lit(False)) for name, limit in limits.items()])


def system_quality(row: dict[str, Column], criteria: QualityCriteria = QualityCriteria()) -> Column:
    """Whether a system passes: its entry does, and all of its limits hold; a missing value fails.

    ``row`` gives entry_pass, num_unresolved_heavy_atoms, num_covalent_ligands, fraction_atoms_with_crystal_contacts, and
    of ligand and pocket (as in ligand_average_rsr) max_alt_count, average_occupancy, average_rscc, average_rsr,
    percent_outliers_clashes, and pocket_num_unresolved_heavy_atoms.
    """
    c = criteria
    rules = [
        row["entry_pass"],
        row["num_unresolved_heavy_atoms"] <= row["num_covalent_ligands"] + c.ligand_max_num_unresolved_heavy_atoms,
        row["fraction_atoms_with_crystal_contacts"] <= c.ligand_max_fraction_atoms_with_crystal_contacts,
        row["pocket_num_unresolved_heavy_atoms"] <= c.pocket_max_num_unresolved_heavy_atoms,
    ]
    for part in ("ligand", "pocket"):
        rules += [
            row[f"{part}_max_alt_count"] <= getattr(c, f"{part}_max_alt_count"),
            row[f"{part}_average_occupancy"] >= getattr(c, f"{part}_min_average_occupancy"),
            row[f"{part}_average_rscc"] >= getattr(c, f"{part}_min_average_rscc"),
            row[f"{part}_average_rsr"] <= getattr(c, f"{part}_max_average_rsr"),
            row[f"{part}_percent_outliers_clashes"] <= getattr(c, f"{part}_max_percent_outliers_clashes"),
        ]
    return reduce(and_, [F.coalesce(r, F.lit(False)) for r in rules])


def residue_summary(
    residues: DataFrame, by: list[str], *, min_rscc: float = 0.8, max_rsr: float = 0.3, min_occupancy: float = 1.0, outliers: tuple[str, ...] = ("geometry", "density", "chirality", "clashes")
) -> DataFrame:
    """Validation of a list of residues by group; ``residues`` has the fields of a residue and ``processed``.

    Means leave out missing and NaN values; percentages are of all residues, also those that weren't processed; a group
    without a processed one is left out.
    """
    done = F.col("processed")

    def mean(c: str) -> Column:
        return F.avg(F.when(done, F.when(~F.isnan(c), F.col(c))))

    def percent(condition: Column) -> Column:
        return 100 * F.sum((done & F.coalesce(condition, F.lit(False))).cast("int")) / F.count(F.lit(1))

    def total(c: str) -> Column:
        return F.sum(F.when(done, F.col(c)))

    found = residues.withColumn("processed", F.coalesce("processed", F.lit(False))).groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_residues"),
        F.sum(done.cast("int")).alias("num_processed_residues"),
        percent(F.lit(True)).alias("percent_processed_residues"),
        *[mean(c).alias(f"average_{c}") for c in ("rsr", "rsrz", "rscc")],
        mean("average_occupancy").alias("average_occupancy"),
        mean("average_b_factor").alias("average_b_factor"),
        percent(F.col("rsr") <= max_rsr).alias("percent_rsr_under_threshold"),
        percent((F.col("rscc") > min_rscc) & ~F.isnan("rscc")).alias("percent_rscc_over_threshold"),
        percent((F.col("average_occupancy") >= min_occupancy) & ~F.isnan("average_occupancy")).alias("percent_occupancy_over_threshold"),
        F.sum((done & F.coalesce("unknown_residue", F.lit(False))).cast("int")).alias("unknown_residue_count"),
        *[total(c).alias(c) for c in ("atom_count", "heavy_atom_count", "num_unresolved_heavy_atoms")],
        F.max(F.when(done, F.col("alt_count"))).alias("max_alt_count"),
        *[percent(F.array_contains("outliers", o)).alias(f"percent_outliers_{o}") for o in outliers],
    )
    return found.where("num_processed_residues > 0")


# Chains, domains and classes of chains.


def chain_rows(entries: DataFrame) -> DataFrame:
    """One row by chain of entry documents."""
    rows = entries.select(F.col("entry.pdb_id").alias("pdb_id"), F.explode("entry.chains").alias("asym_id", "c"))
    return rows.select("pdb_id", "asym_id", *[F.col(f"c.{f}").alias(f) for f in ("auth_id", "entity_id", "chain_type", "length", "holo", "mappings", "residues")])


#: Labels of chain types; what isn't named is UNKNOWN. Fixed values.
CHAIN_LABELS = {
    "SMALLMOLECULE": ("non-polymer",),
    "PEPTIDE": ("polypeptide(L)", "polypeptide(D)"),
    "DNA": ("polydeoxyribonucleotide",),
    "RNA": ("polyribonucleotide",),
    "MIXED": ("polydeoxyribonucleotide/polyribonucleotide hybrid", "peptide nucleic acid"),
    "SACCHARIDE": ("oligosaccharide", "branched", "polysaccharide(D)", "polysaccharide(L)"),
    "MACROCYCLES": ("macrolide", "cyclic-pseudo-peptide"),
}


def chain_label(chain_type: Column) -> Column:
    return scalars.first_true([(chain_type.isin(*types), label) for label, types in CHAIN_LABELS.items()], "UNKNOWN")


def is_ligand_chain(kind: Column, length: Column, has_bird: Column, has_uniprot: Column, *, min_polymer: int = 10, max_peptide: int = 20) -> Column:
    """Whether a chain counts as a ligand: one of a molecule dictionary, or a peptide of few residues that no protein maps
    to, does; another polymer of at least ``min_polymer`` residues and water don't; all else does.

    ``kind`` is polypeptide, polynucleotide, polysaccharide, polymer, water or something else.
    """
    peptide = (kind == "polypeptide") & (length <= max_peptide) & ~F.coalesce(has_uniprot, F.lit(False))
    polymer = kind.isin("polypeptide", "polynucleotide", "polysaccharide", "polymer") & (length >= min_polymer)
    return F.when(kind == "water", False).when(F.coalesce(has_bird, F.lit(False)) | peptide, True).otherwise(~polymer)


def external_mappings(segments: DataFrame) -> DataFrame:
    """Mappings of chains (pdb_id, asym_id, db, accession, start, end) as one map by chain: db → accession → ranges, ordered."""
    one = segments.groupBy("pdb_id", "asym_id", "db", "accession").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ranges"))
    by_db = one.groupBy("pdb_id", "asym_id", "db").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("accession", "ranges")))).alias("by_db"))
    return by_db.groupBy("pdb_id", "asym_id").agg(F.map_from_entries(F.collect_list(F.struct("db", "by_db"))).alias("mappings"))


def domain_ranges(chains: DataFrame, domains: DataFrame) -> DataFrame:
    """Domains of chains, by entry and author chain: pdb_id, asym_id, domain, label, start, end; insertion letters of ends are dropped."""
    held = chains.select("pdb_id", "asym_id", F.col("auth_id").alias("chain"))
    rows = domains.select(F.col("pdb").alias("pdb_id"), "chain", F.col("domainid").alias("domain"), F.col("domain").alias("label"), "pdb_from", "pdb_to")
    found = held.join(rows, ["pdb_id", "chain"]).select("pdb_id", "asym_id", "domain", "label", scalars.digits(F.col("pdb_from")).alias("start"), scalars.digits(F.col("pdb_to")).alias("end"))
    return found.distinct()


def class_ranges(segments: DataFrame, classes: DataFrame) -> DataFrame:
    """Ranges of chains by the family of their accession; ``segments`` as in :func:`external_mappings`, ``classes`` has uniprotac and panther."""
    mapped = segments.where("db = 'UniProt'").join(classes.select(F.col("uniprotac").alias("accession"), F.col("panther").alias("domain")), "accession")
    return mapped.select("pdb_id", "asym_id", "domain", F.col("domain").alias("label"), "start", "end").distinct()


def kinase_ranges(chains: DataFrame, segments: DataFrame, kinases: DataFrame) -> DataFrame:
    """Ranges of chains by kinase: ``kinases`` has pdb, chain (author id), uniprot and kinase."""
    held = chains.select("pdb_id", "asym_id", F.col("auth_id").alias("chain"))
    named = held.join(kinases.select(F.col("pdb").alias("pdb_id"), "chain", F.col("uniprot").alias("accession"), F.col("kinase").alias("domain")), ["pdb_id", "chain"])
    found = named.join(segments.where("db = 'UniProt'"), ["pdb_id", "asym_id", "accession"])
    return found.select("pdb_id", "asym_id", "domain", F.col("domain").alias("label"), "start", "end").distinct()


def pocket_domains(pockets: DataFrame, ranges: DataFrame, *, width: int = 64) -> DataFrame:
    """Of each system the domain that holds most of its pocket residues, of equal ones the first: system_id, domain, label, n.

    ``pockets`` has system_id, pdb_id, asym_id, residue; ranges leave out their end.
    """
    held = interval_join(pockets.distinct(), ranges, at="residue", start="start", end="end", width=width, within=("pdb_id", "asym_id"))
    counts = held.select("system_id", "asym_id", "residue", "domain", "label").distinct().groupBy("system_id", "domain", "label").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("domain", "label", "n"), F.struct((-F.col("n")).alias("n"), F.col("domain").alias("d")))
    return counts.groupBy("system_id").agg(best.alias("best")).select("system_id", "best.*")


# Links, contacts and gaps.

#: Kinds of connections that are kept, and the bases whose hydrogen bonds are. Fixed values.
CONNECTIONS = ("covale", "metalc", "hydrog")
BASES = ("A", "C", "U", "G", "DA", "DC", "DG", "DT", "PSU")


def connections(rows: DataFrame) -> DataFrame:
    """Connections of residues: pdb_id, kind, first, second; a partner is ``auth:comp:asym:seq:atom``.

    ``rows`` has the columns of the connection category, as ptnr1_auth_seq_id. Hydrogen bonds count of bases only.
    """
    rows = rows.where(F.col("conn_type_id").isin(*CONNECTIONS))
    rows = rows.where((F.col("conn_type_id") != "hydrog") | F.trim("ptnr1_label_comp_id").isin(*BASES))

    def partner(n: int) -> Column:
        parts = ("auth_seq_id", "label_comp_id", "label_asym_id", "label_seq_id", "label_atom_id")
        return F.array_join(F.array(*[F.coalesce(F.col(f"ptnr{n}_{p}").cast("string"), F.lit("?")) for p in parts]), ":")

    return rows.select("pdb_id", F.col("conn_type_id").alias("kind"), partner(1).alias("first"), partner(2).alias("second")).distinct()


def linkages(found: DataFrame, ligands: DataFrame, *, kind: str = "covale") -> DataFrame:
    """Links of ligands to neighbouring chains: pdb_id, asym_id, ``linkages`` as ``receptor__ligand``, in order.

    ``ligands`` has pdb_id, asym_id, and neighbors, the ids of chains nearby. Links within a chain are no links.
    """
    chain = lambda c: F.get(F.split(c, ":"), 2)
    rows = found.where(F.col("kind") == kind)
    ends = [F.struct(chain("second").alias("asym_id"), chain("first").alias("near"), F.concat("first", F.lit("__"), "second").alias("link"))]
    ends += [F.struct(chain("first").alias("asym_id"), chain("second").alias("near"), F.concat("second", F.lit("__"), "first").alias("link"))]
    turned = rows.select("pdb_id", F.inline(F.array(*ends))).where("asym_id <> near")
    held = turned.join(ligands.select("pdb_id", "asym_id", "neighbors"), ["pdb_id", "asym_id"]).where(F.array_contains("neighbors", F.col("near")))
    return held.groupBy("pdb_id", "asym_id").agg(F.array_sort(F.collect_set("link")).alias("linkages"))


def proximity_systems(ligands: DataFrame) -> DataFrame:
    """Systems of ligands that neighbour or touch each other, directly or through others: ligand_id, ``component``.

    ``ligands`` has ligand_id and near, the ids of ligands nearby; ids that aren't in the table count for nothing. A
    component goes by its smallest ligand.
    """
    ids = ligands.select("ligand_id").distinct()
    pairs = ligands.select("ligand_id", F.explode("near").alias("other")).join(ids.withColumnRenamed("ligand_id", "other"), "other", "left_semi")
    found = connected_components(pairs, src="ligand_id", dst="other").withColumnRenamed("node", "ligand_id")
    return ids.join(found, "ligand_id", "left").select("ligand_id", F.coalesce("component", "ligand_id").alias("component"))


def interface_gaps(atoms: DataFrame, *, contact: float = 4.5, radii: tuple[float, float] = (4.0, 8.0)) -> DataFrame:
    """Gaps near the interfaces of chains: pdb_id, chain1, chain2, and by radius ``interface_atom_gaps`` and ``missing_interface_residues``.

    ``atoms`` has pdb_id, chain, residue, atom, hetero, x, y, z; gaps are breaks in the numbering of CA atoms of chains that
    aren't hetero. An interface is the residues of two chains with atoms within ``contact``; counted are its atoms within
    the radius of an atom at the edge of a gap of either chain, and the residues at such edges among them. Pairs without
    a gap are left out.
    """
    near = radius_join(atoms, atoms, contact, within=("pdb_id",)).where("l_chain < r_chain")
    pairs = near.select(F.col("l_pdb_id").alias("pdb_id"), F.col("l_chain").alias("chain1"), F.col("r_chain").alias("chain2"), F.col("l_residue").alias("a"), F.col("r_residue").alias("b")).distinct()
    sides = F.array(F.struct(F.col("chain1").alias("chain"), F.col("a").alias("residue")), F.struct(F.col("chain2").alias("chain"), F.col("b").alias("residue")))
    interface = pairs.select("pdb_id", "chain1", "chain2", F.inline(sides)).distinct().join(atoms, ["pdb_id", "chain", "residue"])
    backbone = atoms.where("atom = 'CA' and not hetero").select("pdb_id", "chain", "residue")
    edges = gaps(backbone, by=["pdb_id", "chain"], at="residue").select("pdb_id", "chain", F.explode(F.array("gap_from", "gap_to")).alias("residue")).distinct()
    edge_atoms = edges.join(atoms, ["pdb_id", "chain", "residue"]).withColumn("gap_chain", F.col("chain"))
    marked = interface.join(edges.withColumn("at_edge", F.lit(True)), ["pdb_id", "chain", "residue"], "left")
    with_gap = pairs.select("pdb_id", "chain1", "chain2").distinct().join(edges.select("pdb_id", "chain").distinct(), "pdb_id").where("chain in (chain1, chain2)")
    found = with_gap.select("pdb_id", "chain1", "chain2").distinct()
    for radius in radii:
        close = radius_join(marked, edge_atoms, radius, within=("pdb_id",)).where("r_gap_chain in (l_chain1, l_chain2)")
        close = close.select(*[F.col(f"l_{c}").alias(c) for c in ("pdb_id", "chain1", "chain2", "chain", "residue", "atom", "x", "y", "z", "at_edge")]).distinct()
        counts = close.groupBy("pdb_id", "chain1", "chain2").agg(
            F.count(F.lit(1)).alias(f"interface_atom_gaps_{radius:g}A"),
            F.count_distinct(F.when(F.col("at_edge"), F.struct("chain", "residue"))).alias(f"missing_interface_residues_{radius:g}A"),
        )
        found = found.join(counts, ["pdb_id", "chain1", "chain2"], "left").fillna(0)
    return found


def chain_gaps(found: DataFrame) -> DataFrame:
    """Sums of :func:`interface_gaps` by chain, over all pairs that hold it: pdb_id, chain, and the sums."""
    columns = [c for c in found.columns if c not in ("pdb_id", "chain1", "chain2")]
    return found.select("pdb_id", F.explode(F.array("chain1", "chain2")).alias("chain"), *columns).groupBy("pdb_id", "chain").agg(*[F.sum(c).alias(c) for c in columns])


def with_checks(index: DataFrame, checks: DataFrame) -> DataFrame:
    """Index rows with the checks of their ligand, null where there are none."""
    return index.join(checks, ["system_id", "ligand_instance", "ligand_asym_id"], "left")


def structure_checks(files: DataFrame, check, names: tuple[str, ...]) -> DataFrame:
    """Checks of structure files in batches: ``check`` takes a row as a dict and gives a dict of ``names`` to truth values.

    A check that raises gives null for all of that row. Columns: those of ``files`` and the checks.
    """
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema) + "".join(f", `{n}` boolean" for n in names)

    def one(row: dict) -> list[dict]:
        try:
            found = check(row)
        except Exception:  # noqa: BLE001 - one bad file must not end the job; its checks are null
            found = {}
        return [{**row, **{n: found.get(n) for n in names}}]

    return scalars.map_rows(files, one, shape)
