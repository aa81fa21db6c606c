"""Structure operators: alignment, superposition and atom tables. Chemistry kernels are plug-ins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.scalars import plugin


def global_alignment(a: str, b: str, *, match: float = 1, mismatch: float = -1, opened: float = -10, extended: float = -1) -> list[tuple[int | None, int | None]]:
    """Positions of the best global alignment with affine gaps that are free at the ends; None stands for a gap."""
    n, m = len(a), len(b)
    score = np.full((3, n + 1, m + 1), -np.inf)  # matched, gap in b, gap in a
    score[0, 0, 0] = 0
    score[1, 1:, 0] = score[2, 0, 1:] = 0
    came = np.zeros((3, n + 1, m + 1), np.int8)
    came[1, 1:, 0], came[2, 0, 1:] = 1, 2
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            s = match if a[i - 1] == b[j - 1] else mismatch
            came[0, i, j] = np.argmax(score[:, i - 1, j - 1])
            score[0, i, j] = score[came[0, i, j], i - 1, j - 1] + s
            free_down, free_right = j == m, i == n
            for state, (p, q, free) in ((1, (i - 1, j, free_down)), (2, (i, j - 1, free_right))):
                costs = [score[k, p, q] + (0 if free else extended if k == state else opened) for k in range(3)]
                came[state, i, j] = int(np.argmax(costs))
                score[state, i, j] = max(costs)
    state, i, j, pairs = int(np.argmax(score[:, n, m])), n, m, []
    while i or j:
        before = int(came[state, i, j])
        if state == 0:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif state == 1:
            i -= 1
            pairs.append((i, None))
        else:
            j -= 1
            pairs.append((None, j))
        state = before
    return pairs[::-1]


def identity(a: str, b: str, **scores: float) -> float:
    """Equal residues of the alignment over the shorter length."""
    pairs = global_alignment(a, b, **scores)
    same = sum(i is not None and j is not None and a[i] == b[j] for i, j in pairs)
    return same / max(1, min(len(a), len(b)))


def superimposed(fixed: np.ndarray, mobile: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Rotation and shift that bring ``mobile`` closest to ``fixed`` (n × 3 each), and the RMSD after it."""
    cf, cm = fixed.mean(axis=0), mobile.mean(axis=0)
    u, _, vt = np.linalg.svd((mobile - cm).T @ (fixed - cf))
    turn = np.diag([1, 1, np.sign(np.linalg.det(u @ vt))])
    rotation = u @ turn @ vt
    shift = cf - cm @ rotation
    return rotation, shift, float(np.sqrt((((mobile @ rotation + shift) - fixed) ** 2).sum(axis=1).mean()))


def refined(fixed: np.ndarray, mobile: np.ndarray, *, least: int = 3, spread: float = 1.5, rounds: int = 10) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Superposition that leaves out anchors whose distance is an outlier, until none is; also the anchors in use."""
    use = np.arange(len(fixed))
    if len(use) < least:
        raise ValueError(f"{len(use)} anchors are too few; {least} are needed")
    for _ in range(rounds):
        rotation, shift, rmsd = superimposed(fixed[use], mobile[use])
        distance = np.sqrt(((mobile[use] @ rotation + shift - fixed[use]) ** 2).sum(axis=1))
        q1, q3 = np.quantile(distance, [0.25, 0.75])
        keep = use[distance <= q3 + spread * (q3 - q1)]
        if len(keep) == len(use) or len(keep) < least:
            break
        use = keep
    return rotation, shift, rmsd, use


def renumbered(atoms: DataFrame, *, by: str, residue: str, name: str = "res_id") -> DataFrame:
    """Residue numbers without gaps, from 1, by chain."""
    return atoms.withColumn(name, F.dense_rank().over(Window.partitionBy(by).orderBy(residue)))


def common_atoms(tables: list[DataFrame], keys: list[str]) -> list[DataFrame]:
    """The atoms that all tables have, by key."""
    shared = tables[0].select(*keys).distinct()
    for other in tables[1:]:
        shared = shared.join(other.select(*keys).distinct(), keys, "left_semi")
    return [t.join(shared, keys, "left_semi") for t in tables]


def first_atom(atoms: DataFrame, *, by: list[str], order: str) -> DataFrame:
    """One atom by chain and residue, the first."""
    rest = [c for c in atoms.columns if c not in by]
    return atoms.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("first row")).select(*by, "`first row`.*")


def resolved(atoms: DataFrame, *, by: str, residue: str) -> DataFrame:
    """Residues of each chain, in order."""
    return atoms.groupBy(by).agg(F.array_sort(F.collect_set(residue)).alias("residues"))


def fingerprints(molecules: DataFrame, *, smiles: str, radius: int = 2, size: int = 1024) -> DataFrame:
    """Set bits of circular fingerprints by SMILES. Needs rdkit; ImportError with a clear text where it is missing."""
    plugin("rdkit:Chem")

    def run(batches):
        from rdkit import Chem
        from rdkit.Chem import rdFingerprintGenerator

        make = rdFingerprintGenerator.GetMorganGenerator(radius=radius, fpSize=size)
        for batch in batches:
            found = [Chem.MolFromSmiles(s) for s in batch[smiles]]
            yield batch.assign(bits=[list(make.GetFingerprint(m).GetOnBits()) if m else None for m in found])

    return molecules.mapInPandas(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in molecules.schema)}, bits array<int>")


def concatenated(left: DataFrame, right: DataFrame, *, key: str = "system_id", mark: str = "--") -> DataFrame:
    """Atoms of two structures (one each) as one, whose id joins theirs."""
    name = left.select(key).limit(1).join(right.select(F.col(key).alias("other")).limit(1)).select(F.concat_ws(mark, key, "other").alias("joined"))
    return left.drop(key).unionByName(right.drop(key)).join(F.broadcast(name)).withColumnRenamed("joined", key)


def superimposed_structures(fixed: DataFrame, mobile: DataFrame, *, keys: tuple[str, ...] = ("chain", "residue"), atom: str = "CA") -> tuple[np.ndarray, np.ndarray, float, float]:
    """Rotation, shift, RMSD of all common atoms of a kind and RMSD without outliers, of two structures' atom tables."""
    axes = ("x", "y", "z")
    a = fixed.where(F.col("atom") == atom).select(*keys, *[F.col(c).alias(f"f{c}") for c in axes])
    b = mobile.where(F.col("atom") == atom).select(*keys, *[F.col(c).alias(f"m{c}") for c in axes])
    rows = a.join(b, list(keys)).orderBy(*keys).toPandas()  # atoms of one kind of one structure
    f, m = rows[[f"f{c}" for c in axes]].to_numpy(float), rows[[f"m{c}" for c in axes]].to_numpy(float)
    raw = superimposed(f, m)[2]
    rotation, shift, rmsd, _ = refined(f, m)
    return rotation, shift, raw, rmsd


def common_sequence(left: str, right: str, **scores: float) -> list[tuple[int, int]]:
    """Positions of two sequences that the best alignment puts together and that are equal."""
    return [(i, j) for i, j in global_alignment(left, right, **scores) if i is not None and j is not None and left[i] == right[j]]


def atom_mask(atoms: DataFrame, residues: DataFrame, full: dict[str, tuple[str, ...]]) -> DataFrame:
    """0/1 by atom that a residue should have: system_id, chain, residue, mask.

    ``residues`` has system_id, chain, residue, residue_name and resolved; ``full`` the atoms of each residue name. A
    residue that isn't resolved is all 0, one of an unknown name has an empty mask.
    """
    held = atoms.groupBy("system_id", "chain", "residue").agg(F.collect_set("atom").alias("atoms"))
    table = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for pair in full.items() for x in pair])
    wanted = F.coalesce(F.try_element_at(table, F.col("residue_name")), F.array().cast("array<string>"))
    rows = residues.join(held, ["system_id", "chain", "residue"], "left")
    found = F.transform(wanted, lambda a: (F.col("resolved") & F.coalesce(F.array_contains("atoms", a), F.lit(False))).cast("int"))
    return rows.select("system_id", "chain", "residue", found.alias("mask"))


#: Radii of elements in Å, for surfaces; any other has that of carbon. Fixed values.
RADII = {"C": 1.7, "N": 1.55, "O": 1.52, "S": 1.8, "P": 1.8, "H": 1.2}


def surface(points: np.ndarray, elements: list[str], *, number: int = 200, probe: float = 1.4) -> np.ndarray:
    """Accessible surface of each atom by points on a sphere around it that lie in no other atom's."""
    if not len(points):
        return np.empty(0)
    k = np.arange(number) + 0.5
    polar, turn = np.arccos(1 - 2 * k / number), np.pi * (1 + 5**0.5) * k
    sphere = np.stack([np.cos(turn) * np.sin(polar), np.sin(turn) * np.sin(polar), np.cos(polar)], axis=1)
    radius = np.array([RADII.get(e.upper(), RADII["C"]) for e in elements]) + probe
    out = np.empty(len(points))
    for i, (at, r) in enumerate(zip(points, radius)):
        far = np.sqrt(((points - at) ** 2).sum(axis=1))
        near = np.flatnonzero((far < r + radius) & (np.arange(len(points)) != i))
        dots = at + r * sphere
        free = np.ones(number, bool)
        for j in near:
            free &= ((dots - points[j]) ** 2).sum(axis=1) >= radius[j] ** 2
        out[i] = 4 * np.pi * r**2 * free.mean()
    return out


def buried_surface(a: np.ndarray, b: np.ndarray, elements: tuple[list[str], list[str]], *, number: int = 200) -> int:
    """Surface that two parts lose together, rounded."""
    parts = surface(a, elements[0], number=number).sum() + surface(b, elements[1], number=number).sum()
    return int(round(parts - surface(np.concatenate([a, b]), [*elements[0], *elements[1]], number=number).sum()))


class System:
    """One system of the tables, read when asked for: its entry document, row, files and linked structures.

    ``entries`` has the column ``entry`` (:data:`cairn.operators.annotate.ENTRY`), ``links`` reference_system_id, id and
    kind, ``files`` path and content; each is optional.
    """

    def __init__(self, system_id: str, *, entries: DataFrame | None = None, links: DataFrame | None = None, files: DataFrame | None = None):
        if len(system_id.split("__")) != 4:
            raise ValueError(f"a system id is entry__biounit__chains__ligands, not {system_id!r}")
        self.system_id, self._entries, self._links, self._files = system_id, entries, links, files

    def __repr__(self) -> str:
        return f"System({self.system_id!r})"

    @property
    def entry_id(self) -> str:
        return self.system_id.split("__")[0]

    @property
    def protein_chains(self) -> list[str]:
        return self.system_id.split("__")[2].split("_")

    @property
    def ligand_chains(self) -> list[str]:
        return self.system_id.split("__")[3].split("_")

    @property
    def entry(self) -> dict:
        """The entry document; KeyError where there is none."""
        row = self._entries.where(F.col("entry.pdb_id") == self.entry_id).first() if self._entries is not None else None
        if row is None:
            raise KeyError(f"no entry {self.entry_id}")
        return row["entry"].asDict(recursive=True)

    @property
    def ligands(self) -> DataFrame:
        from cairn.operators import annotate

        return annotate.ligands(self._entries.where(F.col("entry.pdb_id") == self.entry_id)).where(F.col("system_id") == self.system_id)

    @property
    def smiles(self) -> dict[str, str]:
        """SMILES by ligand chain, empty where there is none."""
        return {f"{r['ligand_instance']}.{r['ligand_asym_id']}": r["ligand_rdkit_canonical_smiles"] or "" for r in self.ligands.collect()}

    @property
    def linked_structures(self) -> DataFrame:
        return self._links.where(F.col("reference_system_id") == self.system_id)

    def files(self, pattern: str = ".*") -> dict[str, bytes]:
        """Files of the system by name, of those that match."""
        rows = self._files.where(F.contains("path", F.lit(f"/{self.system_id}/")) & F.col("path").rlike(pattern))
        return {r["path"].rsplit("/", 1)[-1]: bytes(r["content"]) for r in rows.collect()}

    @property
    def sequences(self) -> dict[str, str]:
        """Sequences by chain, of its FASTA file."""
        found: dict[str, str] = {}
        for text in self.files(r"sequences\.fasta$").values():
            for part in text.decode().split(">")[1:]:
                name, *lines = part.split("\n")
                found[name.strip()] = "".join(lines).strip()
        return found
