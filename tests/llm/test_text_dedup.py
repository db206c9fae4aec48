import random

import pytest

from helpers import ODD_TEXTS, docs_frame, groups, jaccard_links, shingles, without_repeats, words
from martflow.llm.jaccard_join import jaccard_components, light_boundary, one_of_each_group, subset_sizes, SIMILARITY
from martflow.llm.suffix_dedup import LogIndex, dedup


def near_copies(seed):
    rng = random.Random(seed)
    rows, i = [], 0
    passage = words(rng, 25)
    for _ in range(25):
        base = words(rng, rng.choice([1, 3, 5, 6, 8, 9, 12, 14, 40, 120])).split()
        for _ in range(rng.randrange(1, 5)):
            copy = list(base)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(3))
            if rng.random() < 0.3:
                copy = copy[:-1] or copy
            text = " ".join(copy)
            rows.append((i, (passage + " " + text) if rng.random() < 0.2 else text.title()))
            i += 1
    return rows


@pytest.mark.parametrize("light", [None, 0, 12])
def test_jaccard_matches_all_pairs(spark, light):
    rows = near_copies(3) + [(1000 + i, t) for i, t, _ in ODD_TEXTS]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard_components(docs_frame(spark, rows, extra=True), light=light).collect()}
    sets = {i: shingles(t) for i, t in rows}
    component = groups(sets, jaccard_links)
    assert got == {i: (len(s), component[i]) for i, s in sets.items()}


def test_jaccard_chain_through_a_hub(spark):
    """a-b and b-c link but a-c does not: the hub of a list is not enough."""
    w = [f"t{i}" for i in range(104)]
    texts = [w, w[:98] + [f"u{i}" for i in range(6)], w[6:98] + [f"u{i}" for i in range(6)] + ["z"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(9, "other words altogether here now")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs_frame(spark, rows)).collect()}
    assert got == groups({i: shingles(t) for i, t in rows}, jaccard_links)


def test_jaccard_boundary_follows_the_cost():
    assert subset_sizes(9, 9, SIMILARITY) == [8]
    assert light_boundary(1.0, SIMILARITY) <= light_boundary(50.0, SIMILARITY)


def test_jaccard_empty_null_ids_and_group_choice(spark):
    assert jaccard_components(docs_frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (7, None)]
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard_components(docs_frame(spark, rows)).collect()),
                 key=str)
    assert got == sorted([(None, None), (5, 2), (2, 2), (2, 2), (7, 7)], key=str)
    kept = sorted(str(r["doc_id"]) for r in one_of_each_group(docs_frame(spark, rows)).collect())
    assert kept == ["2", "2", "7", "None"]


def repeats(seed, n=60):
    rng = random.Random(seed)
    passages = [words(rng, 12) for _ in range(4)]
    out = []
    for i in range(n):
        parts = [words(rng, rng.randrange(0, 15)) for _ in range(3)]
        if rng.random() < 0.6:
            p = rng.choice(passages)
            a = rng.randrange(0, 20)
            parts.insert(1, p[a:] if rng.random() < 0.5 else p)
        out.append((i, " ".join(parts)))
    out += [(n + 1, out[3][1]), (n + 2, out[3][1] + "!"), (n + 3, "ab" * 200), (n + 4, "é" * 90)]
    return out


@pytest.mark.parametrize("hot", [10_000, 2])
def test_repeats_match_every_window(spark, hot):
    rows = repeats(1) + [(1000 + i, t) for i, t, _ in ODD_TEXTS]
    frame = docs_frame(spark, rows, extra=True)
    want = without_repeats(rows, 40)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in dedup(frame, match=40, kmer=8, hot=hot).collect()}
    assert got == want


@pytest.mark.parametrize("hot", [10_000, 2])
@pytest.mark.parametrize("parts", [1, 4])
def test_repeats_of_copies_met_out_of_order(spark, parts, hot):
    """A task that meets a later copy first must not lose the units of the text."""
    rng = random.Random(7)
    passage, inner = words(rng, 20), words(rng, 15)
    text = f"{words(rng, 10)} {passage} {inner} {words(rng, 10)} {inner} tail"
    rows = [(1, f"{words(rng, 10)} {inner}"), (3, text), (7, text), (9, text), (10, f"{passage} {words(rng, 10)}")]
    one = docs_frame(spark, rows[::-1]).coalesce(1)
    frame = one if parts == 1 else one.repartition(parts)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in dedup(frame, match=40, kmer=8, hot=hot).collect()}
    assert got == without_repeats(rows, 40)
    assert got[10][1] > 0 and 0 < got[3][1] < got[3][0] == got[7][1]


def test_repeats_keep_the_bytes_they_say(spark):
    import hashlib
    for r in dedup(docs_frame(spark, repeats(2)), match=40, kmer=8).collect():
        if r["kept"] is not None:
            assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
            assert len(r["kept"]) == r["n_bytes"] - r["n_removed"]


def test_repeats_with_null_and_repeated_ids(spark):
    long = "passage " * 30
    rows = [(None, long), (1, "x" + long), (4, "first text of four"), (4, "y" + long), (6, "same" + long), (6, "same" + long)]
    got = dedup(docs_frame(spark, rows), match=40, kmer=8).collect()
    assert len(got) == 6
    twice = [(r["n_removed"], r["kept_sha256"]) for r in got if r["doc_id"] == 6]
    assert twice[0] == twice[1] and twice[0][0] > 0
    assert [r["n_removed"] for r in got if r["doc_id"] is None] == [0]
    assert dedup(docs_frame(spark, [])).count() == 0


def test_log_index_levels_fall_geometrically():
    rng, index, seen = random.Random(5), LogIndex(20), set()
    for _ in range(30):
        pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(20, 40))) for _ in range(20)]
        want = []
        for p in pieces:
            for i in range(len(p) - 19):
                want.append(p[i:i + 20] in seen)
                seen.add(p[i:i + 20])
        assert index.add(pieces).tolist() == want
    sizes = [len(level.places) for level in index.levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == len(seen)
