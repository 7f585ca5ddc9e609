"""Suffix, line, near-duplicate and benchmark operators against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import helpers as H
from dockwise.llm import decontam, line_dedup, near_dup, suffix_dedup


def multiset(rows):
    return Counter(tuple(r) for r in rows)


def test_repeated_windows_match_brute_force(docs, rows):
    for window in (60, 400):
        got = suffix_dedup.remove_repeats(docs, window).select("doc_id", "kept", "n_bytes", "n_removed", "removed").collect()
        truth = H.removed_windows([r[1] for r in rows], window)
        want = Counter((r[0], kept, len((r[1] or "").encode()), gone, runs) for r, (kept, gone, runs) in zip(rows, truth))
        assert Counter((g["doc_id"], bytes(g["kept"]), g["n_bytes"], g["n_removed"], len(g["removed"])) for g in got) == want


def test_repeated_windows_of_low_entropy_texts(llm):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(500)) for _ in range(4)] + ["ab" * 200, "ab" * 201, "a" * 333, "é" * 90]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(docs, 40).collect()}
    assert got == {i: kept for i, (kept, _, _) in enumerate(H.removed_windows(texts, 40))}


def test_anchor_of_every_window_is_its_leftmost_smallest_gram():
    data = np.random.default_rng(0).integers(97, 100, 3000).astype(np.uint8)
    hasher = suffix_dedup.Hasher()
    hasher.load(data)
    found = suffix_dedup.anchors(hasher, len(data), 100)
    at = np.arange(len(data) - suffix_dedup.GRAM + 1)
    key = hasher.of(at, at + suffix_dedup.GRAM) >> np.uint64(24)
    span = 100 - suffix_dedup.GRAM + 1
    assert found.tolist() == [s + int(key[s : s + span].argmin()) for s in range(len(data) - 99)]


def test_line_dedup_matches_brute_force(docs, rows):
    keys = {(r[0], r[1]) for r in rows}
    common = H.common_lines([(k, k[1]) for k in keys], 10)
    assert common
    want = Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if H.line_key(x) not in common]
        want[(r[0], "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    got = line_dedup.drop_common_lines(docs)
    assert Counter((g["doc_id"], g["text"], g["n_lines"], g["n_dropped"]) for g in got.collect()) == want
    assert got.where("keep IS NULL AND n_dropped > 0").count() == 0


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_hot_line_over_many_partitions(llm, partitions):
    # Runs that begin and end at partition edges, on either side of the threshold.
    texts = [(i, f"hot\nrare {i % 30}\nunique {i}") for i in range(300)]
    before = llm.conf.get("spark.sql.shuffle.partitions")
    llm.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for least, dropped in ((10, 2), (11, 1), (301, 0)):
            got = line_dedup.drop_common_lines(llm.createDataFrame(texts, "doc_id long, text string"), least)
            assert {r["n_dropped"] for r in got.collect()} == {dropped}
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", before)


def test_near_duplicates_match_brute_force(docs, rows):
    want = H.near_classes(rows)
    got = near_dup.classes(docs).collect()
    assert Counter(g["node"] for g in got) == Counter(r[0] for r in rows)
    assert {g["node"]: g["class_id"] for g in got if g["node"] is not None} == want
    assert all(g["kept"] == (g["node"] is None or g["node"] == g["class_id"]) for g in got)


def test_one_row_of_each_class_stays_with_all_columns(docs, rows):
    want = H.near_classes(rows)
    got = near_dup.one_of_each(docs)
    assert got.columns == docs.columns
    kept = [r["doc_id"] for r in got.collect()]
    assert Counter(kept) == Counter({**{c: 1 for c in set(want.values())}, None: 2})


def test_bucket_without_its_leader_in_reach(llm):
    # b and c are alike, a is less like either: the link must be found beside the leader a.
    rng = random.Random(5)
    w = H.prose(rng, 400).split()
    a = list(w)
    for i in range(0, 400, 55):
        a[i] = "other"
    c = list(w)
    c[200] = "changed"
    texts = [(i, " ".join(x)) for i, x in enumerate([a, w, c])] + [(9, H.prose(rng, 300))]
    docs = llm.createDataFrame(texts, "doc_id long, text string")
    got = {r["node"]: r["class_id"] for r in near_dup.classes(docs).collect()}
    assert got == H.near_classes(texts)


def test_texts_that_repeat_a_passage_are_near_duplicates(llm):
    # Equal sets of shingles, counts far apart: only the sets' similarity links them. A plain
    # third text, alike neither by count, is found beside a bucket's leader as well.
    rng = random.Random(17)
    texts, n = [], 0
    for times in (5, 10, 30):
        for _ in range(12):
            plain, passage = H.prose(rng, 150), H.prose(rng, 50)
            edited = plain.split()
            edited[75] = "edited"
            for t in (f"{plain} {passage}", f"{plain} " + " ".join([passage] * times), f"{' '.join(edited)} " + " ".join([passage] * (times // 2))):
                texts.append((n, t))
                n += 1
    docs = llm.createDataFrame(texts, "doc_id long, text string")
    got = {r["node"]: r["class_id"] for r in near_dup.classes(docs).collect()}
    want = H.near_classes(texts)
    assert len(set(want.values())) == n // 3 and got == want


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    a = {int(h): int(w) for h, w in zip(rng.integers(1, 1 << 62, 300), rng.integers(1, 5, 300))}
    b = {h: w + (i % 3 == 0) for i, (h, w) in enumerate(a.items()) if i > 30} | {int(h): 1 for h in rng.integers(1, 1 << 62, 25)}
    truth = H.probability_jaccard(Counter(a), Counter(b))
    agree = []
    for turn in range(40):  # independent hash functions
        shift = lambda d: near_dup._mix(np.array(sorted(d), np.uint64) ^ np.uint64(turn * 977 + 1))
        sig = [near_dup.signatures(shift(d), np.zeros(len(d), np.int64), np.array([d[k] for k in sorted(d)]), 1)[0] for d in (a, b)]
        agree.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(agree) - truth) < 0.02
    exact = near_dup.similarity(*[(np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)])) for d in (a, b)])
    assert abs(exact - max(truth, len(a.keys() & b.keys()) / len(a.keys() | b.keys()))) < 1e-9


def windows_of(item, n=13):
    w = H.words(item)
    k = min(n, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if w else []


def test_decontamination_matches_brute_force(llm, docs, rows):
    rng = random.Random(8)
    long_text = rows[-6][1].split() if rows[-6][1] else []
    items = [
        (1, rows[7][1][:200].upper() + "!"), (2, rows[16][1]), (3, "two-words"), (4, None), (5, "..."), (6, "one"),
        (7, "one"), (10, " ".join(long_text[5:30])), (11, H.prose(rng, 30)), (2, rows[16][1]),
    ]
    bench = llm.createDataFrame(items, "item_id long, text string")
    for settings in ({}, {"block_bytes": 300, "shard_words": 500}):
        got = decontam.judged(decontam.find_matches(docs.select("doc_id", "text"), bench, **settings)).collect()
        want = Counter()
        for r in rows:
            w = H.words(r[1])
            hit, found = set(), set()
            for i, t in items:
                for win in set(windows_of(t)):
                    at = [p for p in range(len(w) - len(win) + 1) if tuple(w[p : p + len(win)]) == win]
                    for p in at:
                        hit.update(range(p, p + len(win)))
                        found.add(str(i))
            want[(r[0], len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w))] += 1
        assert Counter((g["doc_id"], g["n_words"], g["n_hit"], tuple(g["items"]), g["contaminated"]) for g in got) == want
    for g in (g for g in got if g["doc_id"] is not None):  # longest matches are verbatim
        w = H.words({r[0]: r[1] for r in rows}[g["doc_id"]])
        for m in g["matches"]:
            texts = [H.words(t) for i, t in items if str(i) == m["item_id"]]
            assert any(w[m["doc_word"] : m["doc_word"] + m["n_words"]] == t[m["item_word"] : m["item_word"] + m["n_words"]] for t in texts)
    clean = decontam.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter({k[0]: 0 for k in want}) + Counter(k[0] for k, n in want.items() for _ in range(n) if not k[4])


def longest_common(w, v):
    """(length, first place in v, first place in w) of the longest common run of words."""
    best = (0, 0, 0)
    for j in range(len(v)):
        for i in range(len(w)):
            n = 0
            while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                n += 1
            best = max(best, (n, -j, -i))
    return best[0], -best[1], -best[2]


@pytest.mark.parametrize("array", [3, 1 << 20])
def test_longest_matches_equal_brute_force(monkeypatch, array):
    monkeypatch.setattr(decontam, "ARRAY", array)
    rng = random.Random(5)
    for turn in range(200):
        kinds, window = rng.choice([1, 2, 3, 40]), rng.choice([2, 3, 5])
        some = lambda most: [f"w{rng.randrange(kinds)}" for _ in range(rng.randint(0, most))]  # noqa: E731, B023
        items = [some(20) for _ in range(rng.randint(1, 5))]
        texts = [some(30) for _ in range(3)] + [some(5) + items[0] + ["zz"] + items[-1]]
        tests = decontam.TestSuffixes([(str(i), " ".join(v).encode()) for i, v in enumerate(items)], window)
        got = decontam._search([" ".join(w).encode() for w in texts], tests)
        for w, (n, _, matches) in zip(texts, got, strict=True):
            want = [(str(i), *longest_common(w, v)) for i, v in enumerate(items) if v]
            want = [x for x in want if x[1] >= min(window, len(items[int(x[0])]))]
            assert n == len(w)
            assert [(m["item_id"], m["n_words"], m["item_word"], m["doc_word"]) for m in matches] == want


def test_one_word_a_hundred_thousand_times(llm):
    text = "again " * 100_000
    bench = llm.createDataFrame([(1, text), (2, "Again, again"), (3, "once " + text)], "item_id long, text string")
    docs = llm.createDataFrame([(1, text), (2, text + "once more"), (3, "once")], "doc_id long, text string")
    got = {g["doc_id"]: g for g in decontam.judged(decontam.find_matches(docs, bench)).collect()}
    assert [(got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) for i in (1, 2, 3)] == [
        (100_000, 100_000, ["1", "2", "3"]), (100_002, 100_000, ["1", "2", "3"]), (1, 0, [])
    ]
    assert [tuple(m) for m in got[2]["matches"]] == [("1", 0, 0, 100_000), ("2", 0, 0, 2), ("3", 1, 0, 100_000)]


def test_empty_tables(llm, no_docs, docs, rows):
    assert suffix_dedup.digest(no_docs).count() == 0
    assert line_dedup.digest(no_docs).count() == 0
    assert near_dup.digest(no_docs).count() == 0 and near_dup.one_of_each(no_docs).count() == 0
    bench = llm.createDataFrame([], "item_id long, text string")
    assert decontam.digest(no_docs, bench).count() == 0
    got = decontam.digest(docs, bench).collect()
    assert len(got) == len(rows) and {(g["n_hit"], g["n_items"], g["contaminated"]) for g in got} == {(0, 0, False)}
    assert got[0]["items_sha256"] == hashlib.sha256(b"").hexdigest()


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_windows_that_collide_in_polynomial_hashes(llm):
    # Thue-Morse words and their complements have equal sums in any polynomial modulo 2**64.
    texts = [thue_morse(2048, "ab"), thue_morse(2048, "ba"), "x" + thue_morse(1024, "ab"), thue_morse(1024, "ba") + "y"]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs).collect()
    truth = H.removed_windows(texts, 400)
    assert {g["doc_id"]: (bytes(g["kept"]), g["n_removed"], len(g["removed"])) for g in got} == dict(enumerate(truth))


@pytest.mark.parametrize("window", [0, 31, 1056])
def test_windows_outside_the_bounds_are_an_error(docs, window):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs, window)
