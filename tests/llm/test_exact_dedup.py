import hashlib

from cairn.llm.exact_dedup import exact_dedup, exact_groups

LONG = "Ab " * 30_000


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    return sorted((i, max(groups[lower(t)]), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows)


def test_equals_brute_force(docs):
    rows = [
        (1, "Abc"), (2, "aBC"), (3, "abd"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, LONG + "x"), (9, LONG.lower() + "x"),
        (10, LONG + "y"), (11, "a" * 31 + "é"), (12, "a" * 31 + "è"), (13, "a" * 32), (14, "a" * 32), (15, "b" * 40 + "1"), (16, "b" * 40 + "2"),
    ]
    found = exact_groups(docs(*rows)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_small_digits_give_the_same(docs):
    rows = [(i, "x" * (i % 7) + str(i % 5)) for i in range(60)]
    found = exact_groups(docs(*rows), first_digit=1, growth=2).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == brute(rows)


def test_repeated_and_null_ids_leave_one_row(docs):
    found = exact_groups(docs((3, "a"), (3, "a"), (1, "A"), (None, "b"), (None, "b"))).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in found) == [("1", "3", 3), ("3", "3", 3), ("3", "3", 3), ("None", "None", 2), ("None", "None", 2)]
    assert sum(r.kept for r in found if r.doc_id == 3) == 1 and sum(r.kept for r in found if r.doc_id is None) == 1


def test_rows_come_back_whole(docs):
    table = docs((1, "A"), (2, "a"), (3, "b"))
    kept = exact_dedup(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "a"), (3, "b")]


def test_empty_table(docs):
    assert exact_groups(docs()).count() == 0 and exact_dedup(docs()).count() == 0
