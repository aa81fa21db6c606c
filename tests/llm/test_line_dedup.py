import pytest

from cairn.llm.line_dedup import line_dedup

SHAPE = "doc_id long, text string, source string, lines string, key string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SHAPE)


def brute(rows, least):
    trim = lambda x: x.strip(" \t\r")
    sites = {}
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            sites.setdefault(trim(x), set()).add(s)
    gone = {x for x, s in sites.items() if x and len(s) >= least}
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        out.append((i, "\n".join(x for x in lines if trim(x) not in gone), sum(bool(trim(x)) for x in lines), sum(trim(x) in gone for x in lines)))
    return sorted(out, key=str)


def case():
    rows = []
    for k in range(60):
        lines = [f"own {k}", "everywhere", f"  on {k % 3} \r", ""]
        lines += [f"spread {n}" for n in range(1, 25) if k < n]
        rows.append((k, "\n".join(lines), f"site{k}"))
    return [*rows, (100, None, "site1"), (101, "", None), (102, "everywhere\neverywhere\n x" + "y" * 50_000, None), (None, "everywhere\nz", "site2"), (5, "everywhere\nnew", "site3")]


@pytest.mark.parametrize("least", [2, 10, 12])
def test_equals_brute_force(spark, least):
    rows = case()
    found = line_dedup(table(spark, rows), min_sites=least).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in found), key=str) == brute(rows, least)


def test_empty_table(spark):
    assert line_dedup(table(spark, [])).count() == 0
