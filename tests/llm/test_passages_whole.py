"""Every repeat of LEAST_BYTES bytes is found, whatever stands around it."""

import random

from jobloom.llm import gear_chunks

from .messy import documents


def _words(rng, n, longest=9):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, longest))) for _ in range(n))


def _line(rng, n):
    return (_words(rng, 1 + n % 12) + "\n") * (2 + 110 // (1 + n % 12))


def _missed(spark, passages):
    """Passages put into two contexts each of which a copy is not reported, or not up to fewer than REACH bytes at its ends."""
    rng = random.Random(17)
    rows, at = [], {}
    for k, passage in enumerate(passages):
        for d in (2 * k, 2 * k + 1):
            head = _words(rng, rng.randint(0, 60)) + " "
            rows.append((d, head + passage + " " + _words(rng, rng.randint(0, 60)), "en", "s"))
            at[d] = (len(head), len(head) + len(passage))
    found = {}
    for r in gear_chunks.repeated_passages(documents(spark, rows)).collect():
        a, b = at[r["doc_id"]]
        text = rows[r["doc_id"]][1][r["start"]:r["start"] + r["length"]]
        assert text in rows[r["doc_id"] ^ 1][1] or text.count("\n") > 1
        if r["start"] < a + gear_chunks.REACH and r["start"] + r["length"] > b - gear_chunks.REACH:
            found[r["doc_id"]] = r["first_doc_id"]
    return [d for d in at if found.get(d) != d // 2 * 2]


def test_passages_of_51_words_are_all_found(spark):
    rng = random.Random(3)
    assert _missed(spark, [_words(rng, 51) for _ in range(1500)]) == []


def test_short_words_and_the_shortest_passages_are_all_found(spark):
    rng = random.Random(4)
    assert _missed(spark, [_words(rng, 51, 2)[:96] for _ in range(500)]) == []


def test_repeated_lines_are_all_found(spark):
    rng = random.Random(5)
    assert _missed(spark, [_line(rng, n) for n in range(400)] + ["=" * 200, "-+" * 100]) == []
