"""Conversation repair, byte-level BPE and fill-in-middle."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from dockwise.llm import byte_bpe, fill_middle, queries
from dockwise.llm import conversation_repair as CR

GRAMMAR = re.compile(r"(s?(ua)+)?")


# ---------------------------------------------------------------- conversation repair


def all_edits(symbols, inserts):
    """Every edit string with at most `inserts` inserts in a gap: cost, audit, initials."""
    made = [(0, "", "")]
    for symbol in [*symbols, None]:
        gap = [(5 * len(w), "I" * len(w), w) for n in range(inserts + 1) for w in map("".join, itertools.product("ua", repeat=n))]
        made = [(c + d, a + b, r + w) for c, a, r in made for d, b, w in gap]
        if symbol is None:
            return made
        extra, options = 5 * symbol.isupper(), [(2, "D", "")]
        if symbol != "d":
            options += [(extra, "K", symbol.lower())] + [(1 + extra, "R", w) for w in "ua"]
        made = [(c + d, a + b, r + w) for c, a, r in made for d, b, w in options]
    return made


def least(symbols, inserts=2):
    return min((c, a) for c, a, r in all_edits(symbols, inserts) if GRAMMAR.fullmatch(r))


def test_parser_equals_trying_all_edits():
    for n in range(4):
        for symbols in map("".join, itertools.product("suaxdSUAX", repeat=n)):
            assert CR.solve(symbols) == least(symbols, 2 if n < 3 else 1), symbols
    rng = random.Random(5)
    for _ in range(60):
        symbols = "".join(rng.choice("suaxdUA") for _ in range(5))
        assert CR.solve(symbols) == least(symbols, 1), symbols


def test_segments_combine_to_the_whole():
    rng = random.Random(6)
    for _ in range(300):
        symbols = "".join(rng.choice("suauauaxdSUAX") for _ in range(rng.randint(0, 40)))
        fold, at = CR.Fold(), 0
        while at < len(symbols) or at == 0:
            size = rng.randint(0, 9) if at else rng.randint(0, 3)
            fold.add(CR.table(symbols[at : at + size], at_start=not fold.done))
            at += size or 1 if not symbols else size
        assert fold.result() == CR.accepted(CR.parsed({0: (0, "", CR.START)}, symbols)), symbols


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 1:
            text = ""
        elif draw == 2:
            text = re.sub("[.!?]", "", text)
        elif draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def plain_repair(rows, ids):
    """By conversation: the report, and the repaired rows."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    out = {}
    for conv in ids:
        have = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in have if t is not None}
        faults, seen, symbols = [0, 0, 0], set(), ""
        for _, role, text in have:
            body = text.strip(" \t\n\x0b\x0c\r")
            initial = role[:1] if role[:1] and role[:1] in "sua" else "x"
            if not body:
                faults[0] += 1
                symbols += "d"
            elif (role, text) in seen:
                faults[1] += 1
                symbols += "d"
            elif body[-1] not in ".!?":
                faults[2] += 1
                symbols += initial.upper()
            else:
                symbols += initial
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(have, have[1:]))
        cost, audit = state_search(symbols)
        total = sum(c != "D" for c in audit)
        left, queue = [], iter(have)
        for c in audit:
            _, role, text = (None, "", "") if c == "I" else next(queue)
            if c == "D":
                continue
            if c != "K":
                role = ("user", "assistant")[(len(left) - total % 2) % 2]
            left.append((role, text))
        body = "\n".join(f"{r}:{t}" for r, t in left)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = ((gaps, *faults, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest()), left)
    return out


def state_search(symbols):
    """Least (cost, audit) by search over (row, automaton state), independent of the LR tables."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "p", ("p", "u"): "u"}
    here = {"": (0, "")}

    def inserted(tops):
        for _ in range(3):
            for (state, (cost, audit)), t in itertools.product(list(tops.items()), "ua"):
                to = step.get((state, t))
                if to and (cost + 5, audit + "I") < tops.get(to, (1 << 60, "")):
                    tops[to] = (cost + 5, audit + "I")
        return tops

    for symbol in symbols:
        after = {}
        for state, (cost, audit) in inserted(dict(here)).items():
            options = [(state, cost + 2, "D")]
            for t in "sua" if symbol != "d" else "":
                to = step.get((state, t))
                if to and t == symbol.lower():
                    options.append((to, cost + 5 * symbol.isupper(), "K"))
                elif to and t != "s":
                    options.append((to, cost + 1 + 5 * symbol.isupper(), "R"))
            for to, c, e in options:
                after[to] = min(after.get(to, (1 << 60, "")), (c, audit + e))
        here = after
    return min(v for s, v in inserted(here).items() if s in ("", "p"))


CONV_SCHEMA = "conv_id long, turn long, role string, text string, conv string, part string, kind string, copies string"


def conversations(seed=2):
    rng = random.Random(seed)
    rows = []
    for conv in range(120):
        size = rng.randint(1, 9) if conv != 7 else 700  # one long conversation
        for turn in range(size):
            role = "system" if turn == 0 and rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Hello.", "What?", "It is so!", "no end", " \n", "", "ok. ", "yes.\n"]) if rng.random() < 0.5 else f"text {rng.random()}."
            if rng.random() < 0.05:
                role = rng.choice(["", "tool", "User", None, "assistant", "system"])
            if rng.random() < 0.03:
                text = None
            rows.append((conv, None if rng.random() < 0.02 else turn + (rng.random() < 0.05), role, text))
    rows += [rows[3]] * 3 + [(None, 1, "user", "Lost."), (None, None, None, None), (None, 2, "assistant", "Found.")]
    rows += [(500, 4, "user", "again.")] * 300  # one row repeated
    return [(*r, "clash", "clash", "clash", "clash") for r in rows]


@pytest.fixture(scope="module")
def talks(llm):
    return llm.createDataFrame(conversations(), CONV_SCHEMA).repartition(6)


def same_report(got, want):
    keys = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[k] for k in keys) == want[r["conv_id"]][0], r["conv_id"]


@pytest.mark.parametrize("rows, size", [(1024, 1 << 20), (3, 1 << 20), (50, 40)])
def test_digest_equals_brute_force(talks, monkeypatch, rows, size):
    # Small segments: the workers get these values with the function that uses them.
    monkeypatch.setattr(CR, "SEGMENT_ROWS", rows)
    monkeypatch.setattr(CR, "SEGMENT_BYTES", size)
    given = [r[:4] for r in conversations()]
    want = plain_repair(damage(given), {r[0] for r in given})
    same_report(CR.digest(talks).collect(), want)


def test_repaired_rows(talks):
    given = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in conversations()]
    want = plain_repair(given, {r[0] for r in given})
    report, lines = CR.repair(talks)
    same_report(report.collect(), want)
    got = defaultdict(dict)
    for r in lines.collect():
        assert r["position"] not in got[r["conv_id"]]
        got[r["conv_id"]][r["position"]] = (r["role"], r["text"])
    assert {c: [x[i] for i in range(len(x))] for c, x in got.items()} == {c: left for c, (_, left) in want.items() if left}


def test_repair_of_nothing(llm):
    none = llm.createDataFrame([], CONV_SCHEMA)
    assert CR.digest(none).collect() == []
    assert CR.repair(none)[1].collect() == []


def test_conversation_without_rows_left(llm):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = CR.digest(llm.createDataFrame([(gone, 0, "user", "x.")], "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(open(queries.RANKS, "rb").read())


@pytest.fixture(scope="module")
def tik(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_a_bijection(ranks):
    made = byte_bpe.PerfectHash(list(ranks))
    assert sorted(made.number(k) for k in ranks) == list(range(len(ranks)))
    assert byte_bpe.PerfectHash([]).number(b"x") == -1


ODD_TEXTS = [
    "", " ", "a" * 100_000, "ab" * 30_000, "\x1c\x1d a\x85b   c  \n\n d", "日本語 テスト ٣½ ﬁ", "it's I'LL we'd", "<|endoftext|> x",
    " " * 3000 + "x" + "\n" * 2000, "".join(map(chr, range(0x3000))), "😀😀 👩‍👩‍👧", "﻿​᠎",
]


def test_ids_equal_the_library(ranks, tik, rows, monkeypatch):
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, limit=40)
    texts = [*ODD_TEXTS, *(r[1] or "" for r in rows)]
    for part in (1 << 20, 7):
        monkeypatch.setattr(byte_bpe, "PART", part)
        for text in texts:
            assert np.frombuffer(encoder.encode(text), "<i4").tolist() == tik.encode_ordinary(text), text[:60]
            assert len(encoder) <= 40 and len(encoder.older) <= 40


def test_encode_decode_and_digest(llm, docs, rows, tik, no_docs):
    encoded = byte_bpe.encode(docs, queries.RANKS, public_tokenizers.PATTERN)
    want = sorted((repr(r[0]), tik.encode_ordinary(r[1] or "")) for r in rows)
    assert sorted((repr(r["doc_id"]), r["ids"]) for r in encoded.collect()) == want
    back = byte_bpe.decode(encoded, queries.RANKS).collect()
    assert sorted((repr(r["doc_id"]), bytes(r["decoded"])) for r in back) == sorted((repr(r[0]), (r[1] or "").encode()) for r in rows)
    got = byte_bpe.digest(docs, queries.RANKS, public_tokenizers.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    full = [(r[0], tik.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(b))) for i, ids, b in full)
    assert byte_bpe.digest(no_docs, queries.RANKS, public_tokenizers.PATTERN).collect() == []
    nulls = llm.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(byte_bpe.decode(nulls, queries.RANKS).first()["decoded"]) == b""


# ---------------------------------------------------------------- fill-in-middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def test_cuts_equal_the_token_pattern(monkeypatch):
    rng = random.Random(9)
    for least_, most, mask, strip in ((256, 8192, 1023, 1 << 22), (4, 16, 3, 50)):
        for name, value in (("LEAST", least_), ("MOST", most), ("MASK", np.uint32(mask)), ("STRIP", strip)):
            monkeypatch.setattr(fill_middle, name, value)
        cache = fill_middle.Summaries(5000)
        for _ in range(400):
            text = "".join(rng.choice([" ", "\n", "a", "é", "日", " x", "\x85", "\x1c", "w" * 30]) for _ in range(rng.randint(0, 120)))
            tokens = TOKEN.findall(text)
            cuts = fill_middle.Cuts(text.encode(), cache)
            assert cuts.n == len(tokens)
            for k in range(len(tokens) + 1):
                assert cuts.end_of(k) == len("".join(tokens[:k]).encode())


def test_equal_passages_share_chunks():
    rng = random.Random(1)
    passage = " ".join(str(rng.random()) for _ in range(2000)).encode()
    sets = []
    for lead in (b"", b"another beginning " * 9):
        text, start, chunks = lead + passage, 0, set()
        for end in fill_middle.chunk_ends(text):
            chunks.add(text[start:end])
            start = end
        sets.append(chunks)
    assert len(sets[0] & sets[1]) >= 0.9 * len(sets[0])


def plain_fim(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    name = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def test_fim_digest_equals_brute_force(llm, docs, rows, no_docs):
    got = fill_middle.digest(docs)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(plain_fim(r[0], r[1])) for r in rows)
    assert fill_middle.digest(no_docs).collect() == []
    odd = ["a <P> b", "<S>", "x<M>", "< P>", "<<S <", "><", "a<", "<P", "P>", "é" * 9, " \n", "日本 語 "]
    more = [(i, odd[i % len(odd)]) for i in range(600)]
    made = fill_middle.restore(fill_middle.fill_in_middle(llm.createDataFrame(more, "doc_id long, text string"))).collect()
    assert all(r["restored"] == dict(more)[r["doc_id"]] for r in made) and {r["form"] for r in made} == {"plain", "psm", "spm"}
