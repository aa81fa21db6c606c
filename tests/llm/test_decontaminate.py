import itertools
import random
import re

import pytest

from cairn.llm.decontaminate import MASKS, MISSES, WINDOW, covered, decontaminate, overlaps

ITEM = "item_id long, text string, doc_id string"


def items(spark, *rows):
    return spark.createDataFrame([(i, t, "z") for i, t in rows], ITEM)


def test_masks_hit_every_window():
    for gone in itertools.combinations(range(WINDOW), MISSES):
        assert any(
            all(start + k not in gone for k, bit in enumerate(mask) if bit == "1") for mask in MASKS for start in range(WINDOW - len(mask) + 1)
        )


def brute(rows, bench, short_misses=0):
    cut = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    found = {}
    for d, t in rows:
        for i, b in bench:
            words, item = cut(t), cut(b)
            if not item:
                continue
            width = min(WINDOW, len(item))
            need = WINDOW - MISSES if len(item) >= WINDOW else len(item) - (short_misses if len(item) >= 8 else 0)
            for shift in range(-len(item), len(words)):
                same = [0 <= j + shift < len(words) and words[j + shift] == w for j, w in enumerate(item)]
                best = max(sum(same[k : k + width]) for k in range(len(item) - width + 1))
                if best >= need:
                    old = found.get((d, i), (0, 0))
                    found[d, i] = (max(old[0], sum(same)), max(old[1], best))
    return found


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    bench = [(k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate([20, 13, 30, 9, 12, 7, 16])]
    rows = []
    for d in range(40):
        text = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if d % 2:
            passage = bench[d % len(bench)][1].split()
            for _ in range(d % 4):
                passage[rng.randrange(len(passage))] = "swapped"
            at = rng.randint(0, len(text))
            text[at:at] = passage[rng.randint(0, 3) :]
        rows.append((d, ", ".join(text).upper()))
    return [*rows, (100, None), (101, ""), (102, bench[0][1] + " x " + bench[0][1])], [*bench, (50, None), (51, ""), (52, "too short")]


def test_equals_brute_force(docs, spark, case):
    rows, bench = case
    found = overlaps(docs(*rows), items(spark, *bench)).collect()
    assert {(r.doc_id, r.item_id): (r.matched, r.window_matched) for r in found} == brute(rows, bench)


def test_shuffled_join_gives_the_same(docs, spark, case, monkeypatch):
    rows, bench = case
    monkeypatch.setattr("cairn.llm.rows.BROADCAST_ROWS", -1)
    assert overlaps(docs(*rows), items(spark, *bench)).count() == len(brute(rows, bench))


def test_clean_rows_stay_whole(docs, spark):
    passage = " ".join(f"p{k}" for k in range(15))
    table = docs((1, "clean text"), (2, f"before {passage} after"), (2, "repeated id"), (None, passage), (None, "x"), (3, None))
    kept = decontaminate(table, items(spark, (1, passage), (1, passage)))
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert decontaminate(docs(), items(spark, (1, passage))).count() == 0
    assert decontaminate(table, items(spark)).count() == 6


def test_pieces_at_the_edges_of_documents(docs, spark):
    p = [f"p{k}" for k in range(20)]
    pieces = {1: p[:11], 2: p[9:], 3: [*p[8:], "and", "more"], 4: ["before", *p[:12]], 5: p[4:16], 6: p[:10], 7: [*p[:5], "x", *p[6:12]], 8: [*p[:5], "x", *p[6:11]]}
    rows = [(d, " ".join(w)) for d, w in pieces.items()]
    bench = [(1, " ".join(p)), (2, " ".join(p[:13]))]
    found = overlaps(docs(*rows), items(spark, *bench)).collect()
    want = brute(rows, bench)
    assert {d for d, _ in want} == {1, 2, 3, 4, 5, 7} and {(r.doc_id, r.item_id): (r.matched, r.window_matched) for r in found} == want
    assert sorted(r.doc_id for r in decontaminate(docs(*rows), items(spark, *bench)).collect()) == [6, 8]


def test_short_items(docs, spark):
    item = [f"s{k}" for k in range(12)]
    bench = [(n, " ".join(item[:n])) for n in range(1, 13)] + [(20, "!!"), (21, None)]
    rows = [(1, " ".join(item)), (2, " ".join(item[:5])), (3, "s0"), (4, "x s0, S1 y"), (5, "s1 s2 s3 s4"), (6, " ".join([*item[:3], "z", *item[4:9]])), (7, " ".join(["a"] * 3 + item[:8]))]
    found = overlaps(docs(*rows), items(spark, *bench)).collect()
    want = brute(rows, bench)
    assert {(r.doc_id, r.item_id): (r.matched, r.window_matched) for r in found} == want
    assert {i for d, i in want if d == 1} == set(range(1, 13)) and {i for d, i in want if d == 2} == set(range(1, 6)) and (3, 1) in want


def test_substitutions_in_short_items(docs, spark):
    item = [f"s{k}" for k in range(12)]
    assert covered(12, 1) and covered(WINDOW, MISSES) and not covered(8, 1)
    rows = [(k, " ".join(["a", *item[:k], "swapped", *item[k + 1 :], "b"])) for k in range(12)] + [(50, " ".join([*item[:3], "x", "y", *item[5:]]))]
    bench = [(1, " ".join(item)), (2, "s0 s1 s2 never")]
    found = overlaps(docs(*rows), items(spark, *bench), short_misses=1).collect()
    assert {(r.doc_id, r.item_id): (r.matched, r.window_matched) for r in found} == brute(rows, bench, 1)
    assert len(found) == 12
    with pytest.raises(ValueError):
        overlaps(docs(*rows), items(spark, (1, " ".join(item[:8]))), short_misses=1)


def test_long_text_with_many_hits(docs, spark):
    passage = " ".join(f"p{k}" for k in range(15))
    rows = [(1, f"{passage} and " * 600), (None, f"{passage} x"), (None, "clean"), (1, "another row of the id")]
    bench = [(1, passage), (2, passage), (3, " ".join(passage.split()[:9] + ["q"] * 6))]
    found = overlaps(docs(*rows), items(spark, *bench)).collect()
    assert sorted((str(r.doc_id), r.item_id, r.matched) for r in found) == [("1", 1, 15), ("1", 2, 15), ("None", 1, 15), ("None", 2, 15)]
