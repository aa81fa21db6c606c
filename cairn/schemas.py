"""Declared schemas of the data model, with a description in each field's metadata."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True, {"comment": text}) for name, kind, text in fields])


S, D, I, L, B, Y = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.ByteType()

PROTEIN_SIMILARITY = _schema(
    ("query_system", S, "id of the system whose size normalises the score"),
    ("target_system", S, "id of the system compared with"),
    ("protein_mapping", S, "mapping of protein chains"),
    ("mapping", S, "mapping of chains of any kind"),
    ("protein_mapper", S, "search that mapped the chains"),
    ("source", S, "search that gave the score"),
    ("metric", S, "name of the score"),
    ("similarity", Y, "score from 0 to 100"),
    ("search_db", S, "kind of target: holo, apo or pred"),
)
LIGAND_SIMILARITY = _schema(
    ("query_ligand_id", I, "number of the query ligand"),
    ("target_ligand_id", I, "number of the target ligand"),
    ("tanimoto_similarity_max", Y, "largest fingerprint similarity, 0 to 100"),
)
CLUSTERS = _schema(
    ("system_id", S, "id of the system"),
    ("label", S, "label of its cluster, c0 being the largest"),
    ("metric", S, "score that links systems"),
    ("cluster", S, "components or communities"),
    ("directed", B, "whether the links have a direction"),
    ("threshold", Y, "least score of a link"),
)
SPLITS = _schema(
    ("system_id", S, "id of the system"),
    ("uniqueness", S, "group of redundant systems"),
    ("split", S, "train, val, test or removed"),
    ("cluster", S, "cluster that the test set is drawn from"),
    ("cluster_for_val_split", S, "cluster that the validation set is drawn from"),
)
SCHEMAS = {
    "protein_similarity": PROTEIN_SIMILARITY,
    "ligand_similarity": LIGAND_SIMILARITY,
    "clusters": CLUSTERS,
    "splits": SPLITS,
}
SEARCH_KINDS = ("apo", "holo", "pred")

#: The stored metrics: a base score and, for whole proteins, how chains are combined. Fixed names.
BASE_PROTEIN = ("lddt", "lddt_qcov", "qcov", "fident", "fident_qcov", "seqsim", "seqsim_qcov")
BASE_POCKET = ("lddt", "lddt_qcov", "qcov", "fident", "fident_qcov")
COMBINED = ("max", "weighted_max", "weighted_sum")
METRICS = (
    *(f"protein_{b}_{c}" for b in BASE_PROTEIN for c in COMBINED),
    *(f"pocket_{b}" for b in BASE_POCKET),
    "pli_qcov",
    "pli_unique_qcov",
)
THRESHOLDS = (50, 70, 95, 100)


def cluster_column(metric: str, threshold: int, cluster: str, directed: bool) -> str:
    """Name of the index column that holds a clustering."""
    if cluster == "communities":
        return f"{metric}__{threshold}__community"
    return f"{metric}__{threshold}__{'strong' if directed else 'weak'}__component"


def cluster_description(name: str) -> str | None:
    """What a cluster column holds, from its name; None for another column."""
    parts = name.split("__")
    if len(parts) == 3 and parts[2] == "community":
        return f"community at {parts[0]} of {parts[1]} or more"
    if len(parts) == 4 and parts[3] == "component":
        return f"{parts[2]}ly connected component at {parts[0]} of {parts[1]} or more"
    return None


def dictionary(schema: T.StructType) -> list[tuple[str, str, str]]:
    """Rows of a data dictionary: name, type, description. Names that start with ``__`` are internal and left out."""
    rows = []
    for field in schema:
        if not field.name.startswith("__"):
            text = (field.metadata or {}).get("comment") or cluster_description(field.name) or ""
            rows.append((field.name, field.dataType.simpleString(), text))
    return rows
