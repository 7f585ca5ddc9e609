"""Tokens, personal data, toxicity, archives, mixing, embeddings and the pipeline."""

import hashlib
import json
import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import helpers as H
from dockwise.llm import common, embed_dedup, mixing, pii, queries, tokens, toxicity, warc


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.TOKENIZER)


ODD = ["<|endoftext|>", "a<|startoftext|> b", "it's I'LL x's", "İstanbul ΣΑΣ ß ŉ", "été ﬁ ½ 12٣", "a b c\x1cd\x85e", ",. ., a.b,c", "日本語 テスト", "́x"]


def test_word_ids_equal_the_tokenizer(tokenizer, rows):
    ids = tokens.WordIds(open(queries.TOKENIZER, encoding="utf-8").read(), limit=50)
    for text in [*ODD, *(r[1] or "" for r in rows)]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.text(text, b""), "<u4").tolist() == want, text[:80]
        assert len(ids) <= 50 and len(ids.older) <= 50


def test_words_of_a_column_are_looked_up_once(tokenizer, rows, monkeypatch):
    ids = tokens.WordIds(open(queries.TOKENIZER, encoding="utf-8").read(), limit=5000)
    # Forms of a word share what is encoded: the word, and the punctuation behind it.
    encoded, encode = [], ids._encode
    monkeypatch.setattr(ids, "_encode", lambda chunk: encoded.append(chunk) or encode(chunk))
    forms = "été Été ÉTÉ été, Été!!! été$$$ ÉTÉ!!! word Word$$$ word! WORD!!! é1"
    want = np.array(tokenizer.encode(forms, add_special_tokens=False).ids, "<u4").tobytes()
    assert list(ids.texts(pa.array([forms, None, forms]), b"")) == [want, b"", want]
    assert sorted(encoded) == sorted(["été", "word", ",", "!", "!!!", "$$$", "é1", ""])
    # Of any cut into parts, also with every Latin letter and all punctuation behind a word.
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    odd = [*ODD, " ".join(letters), " ".join(f"x{c}Y" for c in letters), " ".join(f"Ab{c}{d}" for c in string.punctuation for d in string.punctuation)]
    column = [*odd, None, "", *(r[1] for r in rows)]
    want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for t in column]
    for part in (1, 300, 1 << 20):
        monkeypatch.setattr(tokens, "PART", part)
        for kind in (pa.string(), pa.large_string()):
            assert list(ids.texts(pa.array(column, kind), want[len(odd)])) == want
            assert list(ids.texts(pa.array(column, kind).slice(3), want[len(odd)])) == want[3:]
    assert list(ids.texts(pa.array([], pa.string()), b"")) == []


def test_shards_round_trip(llm, docs, rows, tokenizer):
    folder = common.shared_folder(llm, "test-tokens")
    manifest = tokens.write_shards(docs, folder, queries.TOKENIZER)
    got = sorted(tokens.read_shards(manifest).collect(), key=lambda r: r["start"])
    at, seen = 0, []
    for r in got:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]
        seen.append((r["doc_id"], tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist())))
    order = [(d is not None, d) for d, _ in seen]
    assert [o[0] for o in order] == sorted(o[0] for o in order) and [d for _, d in order if d is not None] == sorted(d for _, d in order if d is not None)
    assert Counter(seen) == Counter((r[0], tuple([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1])) for r in rows)
    crc = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in tokens.checksums(manifest).collect()}
    assert crc == {(r["doc_id"], r["start"]): zlib.crc32(bytes(r["ids"])) for r in got}
    # Random access to one document of a shard; another dictionary is refused.
    path = manifest.orderBy("docs", ascending=False).first()["path"]
    shard = tokens.open_shard(path)
    i = len(shard.doc_ids) - 1
    assert len(shard.ids(i)) == 4 * shard.counts[i]
    with pytest.raises(ValueError):
        tokens.Shard(shard.source, b"another")


def test_shards_of_nothing(llm, no_docs):
    assert tokens.round_trip(llm, no_docs, queries.TOKENIZER).count() == 0


# ---------------------------------------------------------------- personal data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(pii.PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def personal_texts():
    rng = random.Random(4)
    parts = [
        "a.b@c.d_e@f.gh", "x@y", "x@y.z.", "a@b@c.de", "+@+.+", "é@b.co", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.255", "1.2.3",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "4111111111111111 5", "+1 (555) 123-4567", "+49.30.1234567890123", "++1 2345678 9",
        "12 34-56 7", "😀 a@b.cd 😀", "%%@a-b.c-d", "\n", "and", ".", "@", "+", "5", "-",
    ]
    return ["".join(rng.choice([" ", "", ",", "\n"]) + rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(300)]


def test_base_spans_match_the_given_patterns(llm):
    long = ["9" * 60000, "a" * 60000 + "@", "1." * 20000, "a@b." * 5000, "1 " * 20000, "+1" * 5000]
    texts = [None, "", *personal_texts(), *long]
    docs = llm.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[3])], "doc_id long, text string")
    got = pii.digest(docs).collect()
    assert len(got) == len(texts) + 2
    for g in got:
        base = base_spans(texts[g["doc_id"] if g["doc_id"] is not None else 3] or "")
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base)
        assert g["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [g[f"n_{k}"] for k in pii.KINDS] == [sum(b[3] == k for b in base) for k in pii.KINDS]
        assert [s for s in g["spans"].split(",") if s and not s.startswith("term")] == [s for s in listed.split(",") if s]


def test_terms_that_give_an_entity_away(llm):
    rng = random.Random(6)
    other = [H.prose(rng, 30) for _ in range(200)]
    told = [f"{H.prose(rng, 20)} Zorvax the {i}kx write to jo@ex.org today {H.prose(rng, 20)}" for i in range(6)]
    common = [t + " the today write to" for t in other]
    docs = llm.createDataFrame(list(enumerate(told + common + [told[0]] * 3)), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.digest(docs).collect()}
    for i, t in enumerate(told):
        at = t.index("Zorvax")
        assert f"term:{at}:{at + 6}" in spans[i].split(",")
        assert spans[i].count("term") == 1  # not the words found everywhere, nor those of one text
    assert not any("term" in spans[i] for i in range(6, 206))
    clean = {r["_id"]: r["text"] for r in pii.sanitised(docs).collect()}
    assert "Zorvax" not in clean[0] and "jo@ex.org" not in clean[0] and "[EMAIL]" in clean[0] and clean[10] == common[4]
    plan = pii.digest(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_context_words_are_those_of_the_whole_text(llm):
    long = "x" * 5000
    parts = personal_texts()[:120]
    parts += ["Zorvax room 12, 4111 1111 1111 1111 and 17", "mail a@b.cd, c@d.ef, g@h.ij to Zorvax", f"one two three {long} q@r.st {long} four", "é😀 " * 1500 + "\na@b.cd " + "日本" * 3000, "éa@b.cdé"]
    docs = llm.createDataFrame([(i, t) for i, t in enumerate(parts)], "doc_id long, text string")
    keyed = common.with_row_key(docs, "doc_id", "text").selectExpr("*", "xxhash64(text) AS _t1", "xxhash64('second', text) AS _t2")
    got = Counter()
    ids = {(r["_k1"], r["_k2"]): r["doc_id"] for r in keyed.collect()}
    for r in pii.contexts(pii.base_spans(keyed), pii.holding(keyed)).collect():
        got[(ids[r["_k1"], r["_k2"]], r["term"], r["start"], r["end"])] += 1
    want = Counter()
    for i, t in enumerate(parts):
        for start, _, end, _ in base_spans(t):
            words = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t[:start])][-8:]
            words += [(m.start() + end, m.end() + end) for m in re.finditer(r"[^\W_]+", t[end:])][:8]
            want.update((i, t[a:b].lower(), a, b) for a, b in words)
    assert got == want


def test_disclosing_terms_beyond_other_matches_and_at_all_places(llm):
    rng = random.Random(16)
    told = [f"{H.prose(rng, 20)} Zorvax room {i + 10}, 4111 1111 1111 1111 {H.prose(rng, 40)} zorvax {H.prose(rng, 9)}" for i in range(6)]
    docs = llm.createDataFrame(list(enumerate(told + [H.prose(rng, 30) + " room" for _ in range(200)])), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"].split(",") for r in pii.digest(docs).collect()}
    for i, t in enumerate(told):
        assert [s for s in spans[i] if s.startswith("term")] == [f"term:{m.start()}:{m.end()}" for m in re.finditer("(?i)zorvax", t)]


def plain_disclosures(texts, prior=2.0, least=0.75):
    """Degrees by (entity, term), counted in plain Python; `texts` holds copies as often as they occur."""
    near, held, having = Counter(), Counter(), Counter()
    kinds = defaultdict(set)
    for t in texts:
        t = t or ""
        having.update({w.lower() for w in re.findall(r"[^\W_]+", t)})
        pairs, entities = set(), set()
        for start, _, end, kind in base_spans(t):
            value = t[start:end].lower() if kind == "email" else re.sub("[^0-9.]", "", t[start:end])
            entities.add(f"{kind}:{value}")
            words = re.findall(r"[^\W_]+", t[:start])[-8:] + re.findall(r"[^\W_]+", t[end:])[:8]
            pairs.update((f"{kind}:{value}", w.lower()) for w in words)
        near.update(pairs)
        held.update(entities)
        for pair in pairs:
            kinds[pair].add(t)
    out = {}
    for (e, w), n in near.items():
        information = math.log2(len(texts) / held[e])
        if information > 0:
            degree = 1 + math.log2(n / (max(having[w], n) + prior * n / len(kinds[e, w]))) / information
            if degree >= least:
                out[e, w] = degree
    return out


def test_disclosures_equal_plain_counts(llm):
    rng = random.Random(31)
    texts = [f"{H.prose(rng, 12)} call jo{i % 7}@ex.org or {rng.choice(['zab', 'qix'])} {H.prose(rng, 6)}" for i in range(40)]
    texts += [f"only one uniqueword here 10.2.3.{i} {H.prose(rng, 9)}" for i in range(3)] + texts[:2] * 3 + [H.prose(rng, 25) for _ in range(150)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = common.with_row_key(docs, "doc_id", "text").selectExpr("*", "xxhash64(text) AS _t1", "xxhash64('second', text) AS _t2")
    seen = common.stage(pii.contexts(pii.base_spans(keyed), pii.holding(keyed)), "test-contexts")
    got = {(r["entity"], r["term"]): r["degree"] for r in pii.disclosures(keyed, seen, 2.0, 0.75).collect()}
    want = plain_disclosures(texts)
    assert got.keys() == want.keys() and want and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    # Rare entities have estimates: a word that occurs beside one of them alone.
    assert any(k[0].startswith("ip:") for k in want)


# ---------------------------------------------------------------- toxicity


def test_toxicity_on_held_out_rows(llm):
    rng = random.Random(9)
    bad = ["vile", "rotten", "lowlife"]
    data, labels = [], []
    for i in range(1600):
        w = H.prose(rng, rng.choice([20, 60, 400])).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        data.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    data += [(5000, None), (5001, ""), (None, "vile"), (0, data[0][1])]
    labels += [(None, 1, 1), (3, 1, None), (99999, 1, 1)]
    docs = llm.createDataFrame(data, "doc_id long, text string")
    got = toxicity.digest(docs, llm.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(data)
    assert all(g["held_out"] == (g["doc_id"] is not None and zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2) for g in got)
    assert all(0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.3) for g in got)
    tested = [(g["predicted"], int(g["doc_id"] % 4 == 0)) for g in got if g["held_out"] and g["doc_id"] < 1600]
    assert np.mean([p == y for p, y in tested]) > 0.97
    empty = {g["score"] for g in got if g["doc_id"] in (5000, 5001)}
    assert len(empty) == 1 and max(empty) < 0.3


def test_toxicity_without_labels(llm, docs, rows):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.digest(docs, none).collect()} == {0.0}
    kept = toxicity.clean_documents(docs, none)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_texts_over_the_sample_bound_do_not_end_it(llm):
    rng = random.Random(10)
    data = [(i, H.prose(rng, 30) + (" vile rotten" if i % 4 == 0 else "")) for i in range(600)]
    hashes = {r["id"]: r["h"] for r in llm.sql("SELECT id, xxhash64(id) AS h FROM range(600)").collect()}
    firsts = sorted((i for i in hashes if zlib.crc32(str(i).encode()) % 4 != 2), key=hashes.get)
    for n, i in enumerate(firsts[:3]):  # first of all: too long alone, then too long together
        data[i] = (i, data[i][1] + " filler" * (60_000 if n == 0 else 30_000))
    docs = llm.createDataFrame(data, "doc_id long, text string")
    labels = llm.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    model = toxicity.load(toxicity.fit(docs, labels, sample_bytes=300_000))
    assert model.trained
    got = model.scores(toxicity.Hasher(), [b"a vile rotten thing", b"abc def ghi"])
    assert got[0] >= 0.3 > got[1]
    few = toxicity.load(toxicity.fit(docs, labels, sample_bytes=500))
    assert all(0 <= x <= 1 for x in few.scores(toxicity.Hasher(), [b"", b"a vile rotten thing"]))


def test_every_labelled_text_trains_whole(llm):
    """Words that only texts beyond any bound have are learned, in several parts and blocks."""
    rng = random.Random(12)
    data = [(i, H.prose(rng, 30) + (" vile rotten" if i % 4 == 0 else "")) for i in range(400)]
    long = [(i, H.prose(rng, 3000) + (" hideous" if i % 2 else "")) for i in range(1000, 1120)]
    docs = llm.createDataFrame(data + long, "doc_id long, text string")
    labels = llm.createDataFrame([(i, int(i % 4 == 0)) for i, _ in data] + [(i, i % 2) for i, _ in long], "doc_id long, toxic int")
    path = toxicity.fit(docs, labels, sample_bytes=4000, part_bytes=200_000)
    model = toxicity.load(path)
    row = toxicity.buckets(toxicity.Hasher(), [b"hideous"])[0][0]
    assert all(model.embed[t][row[t], 0] > 0.5 for t in range(toxicity.TABLES))
    got = model.scores(toxicity.Hasher(), [b"a vile rotten thing", b"a hideous thing", b"abc def ghi"])
    assert min(got[:2]) >= 0.3 > got[2]
    again = toxicity.load(toxicity.fit(docs.repartition(3), labels, sample_bytes=4000, part_bytes=200_000))
    assert np.array_equal(model.embed, again.embed) and model.levels == again.levels


def test_long_texts_descend_in_chunks(monkeypatch):
    rng = random.Random(4)
    data = [toxicity.buckets(toxicity.Hasher(), [H.prose(rng, n).encode()])[0] for n in (300, 5, 900, 40)]
    found = []
    for chunk in (100_000, 50):
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        model = toxicity.Model(0.5)
        model.embed[:, :-1] = np.random.default_rng(1).normal(size=model.embed[:, :-1].shape)
        toxicity.Descent(model).run(data, np.array([1, 0, 1, 0], np.float32), 2)
        found.append((model.embed, model.out))
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(*found))


@pytest.mark.parametrize("marks", [[0, 1], [0, 0, 1, 0, 0, 1], [1], [0, 0], [1, 1, 0]])
def test_toxicity_with_few_labels(llm, no_docs, marks):
    texts = ["abc def ghi jkl", "a vile rotten thing"]
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2][: len(marks)]
    docs = llm.createDataFrame([(i, texts[m]) for i, m in zip(ids, marks)] + [(777, "vile rotten"), (778, None)], "doc_id long, text string")
    labels = llm.createDataFrame([(i, 0, m) for i, m in zip(ids, marks)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.digest(docs, labels).collect()}
    assert len(got) == len(marks) + 2 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    if len(set(marks)) == 2:
        assert all(got[i]["predicted"] == m for i, m in zip(ids, marks))
    assert toxicity.digest(no_docs, labels).collect() == []


def test_training_lowers_the_loss():
    rng = random.Random(3)
    texts = [(H.prose(rng, 20) + (" vile" if i % 2 else "")).encode() for i in range(64)]
    y = np.array([i % 2 for i in range(64)])
    before, after = toxicity.train(texts, y, epochs=0), toxicity.train(texts, y, epochs=3)

    def loss(model):
        p = 1 / (1 + np.exp(-model.raw(toxicity.Hasher(), texts[:48])))
        return float(-np.mean(np.where(y[:48] == 1, np.log(p + 1e-9), np.log(1 - p + 1e-9))))

    assert loss(after) < loss(before)


def test_long_texts_are_scored_whole():
    model = toxicity.Model(0.1)
    rng = np.random.default_rng(1)
    model.embed[:, :-1] = rng.normal(size=model.embed[:, :-1].shape)
    data = toxicity.buckets(toxicity.Hasher(), [b"word " * 300000 + b"strange", b"short one"])
    parts = model._chunked(*data)
    whole = np.concatenate([model.pooled(model.lookup(data[0][a:b]), np.zeros(1, np.int64))[0] for a, b in zip(data[1], [*data[1][1:], len(data[0])])])
    assert np.allclose(parts, whole, atol=1e-5)


# ---------------------------------------------------------------- archives


def pages():
    rng = random.Random(2)
    big = "<p>" + H.prose(rng, 400, True)
    rows = [(i, f"http://x/{i}", t, "clash") for i, t in enumerate([None, "", "small", "small", big, big, big, big + "!", "\x1f\x8b\x08 WARC/1.1\r\n" * 100])]
    rows += [(40 + i, "u", big, "c") for i in range(30)] + [(200, "u", big, "c"), (200, "u", big, "c"), (None, "u", "null id", "c")]
    return rows, big


def test_archive_round_trip(llm):
    rows, big = pages()
    table = llm.createDataFrame(rows, "page_id long, url string, html string, _digest string").repartition(4)
    got = warc.round_trip(llm, table).collect()
    top = {}
    for i, _, t, _ in rows:
        if i is not None:
            top[t or ""] = max(top.get(t or "", i), i)
    want = Counter()
    for i, _, t, _ in rows:
        b = (t or "").encode()
        again = len(b) >= 1000 and i != top[t or ""] and i is not None
        want[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top[t] if again else None)] += 1
    assert Counter((g["page_id"], g["payload_bytes"], g["payload_digest"], g["record_type"], g["refers_to"]) for g in got) == want
    assert warc.round_trip(llm, table.limit(0)).count() == 0


def test_ranges_own_the_records_that_start_in_them():
    import io

    bodies = [b"WARC/1.1\r\nWARC-Type: x\r\n" * k + bytes([k]) * 50 for k in range(40)]
    file = b"".join(warc._record("response", str(k), None, hashlib.sha1(b).hexdigest(), len(b), b) for k, b in enumerate(bodies))
    for step in (1, 7, 100, 333, len(file)):
        found = []
        for a in range(0, len(file), step):
            found += [(at, body) for at, _, body in warc.scan_range(io.BytesIO(file), len(file), a, min(len(file), a + step), piece=64)]
        assert [b for _, b in found] == bodies and len({at for at, _ in found}) == len(bodies)


def test_records_of_other_writers_and_mandatory_fields():
    import gzip
    import io

    file = b"".join(
        gzip.compress(h + b"\r\n\r\n" + b"body" + b"\r\n\r\n")
        for h in (
            b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 4",
            b"WARC/1.1\r\nwarc-type:response\r\nWarc-Record-Id:  <b>\r\ncontent-length:4",
        )
    )
    found = list(warc.scan_range(io.BytesIO(file), len(file), 0, len(file)))
    assert [(f[b"warc-record-id"], b) for _, f, b in found] == [(b"<a>", b"body"), (b"<b>", b"body")]
    broken = gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nbody")
    with pytest.raises(ValueError, match="warc-record-id"):
        list(warc.scan_range(io.BytesIO(broken), len(broken), 0, len(broken)))
    for refers in (None, "7"):
        made = gzip.decompress(warc._record("revisit" if refers else "response", "1", refers, "ab", 4, b"body", "2021-06-19T00:00:00Z", "http://x/a b"))
        head = made.split(b"\r\n\r\n")[0].decode().split("\r\n")
        assert "WARC-Date: 2021-06-19T00:00:00Z" in head and "WARC-Target-URI: http://x/a%20b" in head
        assert (f"WARC-Profile: {warc.PROFILE}" in head) == (refers is not None)


# ---------------------------------------------------------------- mixing


def filled(sizes, weights, share=1.5, repeat=2):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        level = (budget - sum(repeat * sizes[s] for s in full)) / (sum(weight[s] for s in names if s not in full) or math.inf)
        over = {s for s in names if s not in full and level * weight[s] > repeat * sizes[s]}
        if not over:
            return {s: repeat * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def test_mix_meets_its_targets(docs, rows):
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = filled(sizes, (3, 1, 2))
    got = mixing.mix(docs, packet=8).collect()
    assert Counter((g["_id"], g["size"]) for g in got) == Counter((r[0], size(r[1])) for r in rows)
    taken = Counter()
    for g in got:
        assert g["source_size"] == sizes[g["source"]] and abs(g["target"] - want[g["source"]]) < 1e-6
        assert 0 <= g["taken"] <= 2 * g["size"]
        taken[g["source"]] += g["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 30, s
    assert sum(taken.values()) <= 1.5 * sum(sizes.values()) + 1e-6
    again = mixing.digest(docs.repartition(9)).collect()
    assert Counter(again) == Counter(mixing.digest(docs).collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and max(Counter(r["doc_id"] for r in mixed.collect() if r["doc_id"] not in (27, 42, None)).values()) <= 2


@pytest.mark.parametrize(("packet", "bucket_rows"), [(8, 2000), (256, 1)])
def test_what_the_mix_takes_equals_a_plain_queue(docs, rows, packet, bucket_rows):
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    target = filled(sizes, (3, 1, 2))
    served = []
    for source in sizes:
        queue = [(digest(f"{mixing.SEED}:{'' if r[0] is None else r[0]}:{source or ''}:{digest(r[1] or '')}"), r) for r in rows if r[3] == source]
        at = 0
        for _, r in sorted(queue, key=lambda q: q[0]) * 2:
            for start in range(0, size(r[1]), packet):
                n = min(packet, size(r[1]) - start)
                at += n
                served.append((at / target[source], source is not None, source or "", n, (r[0], source, r[1])))
    budget, taken, total = sum(target.values()), Counter(), 0
    for _, _, _, n, row in sorted(served, key=lambda x: x[:3]):
        total += n
        if total <= budget:
            taken[row] += n
    repeats = Counter((r[0], r[3], r[1]) for r in rows)
    want = Counter((r[0], r[3], size(r[1]), taken[r[0], r[3], r[1]] // repeats[r[0], r[3], r[1]]) for r in rows)
    got = mixing.mix(docs, packet=packet, bucket_rows=bucket_rows).collect()
    assert Counter((g["_id"], g["source"], g["size"], g["taken"]) for g in got) == want


def test_mix_of_nothing(no_docs, llm):
    assert mixing.digest(no_docs).count() == 0
    blank = llm.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert {(r["taken"], r["target"]) for r in mixing.digest(blank).collect()} == {(0, 0.0)}


# ---------------------------------------------------------------- embeddings


def vectors():
    rng = np.random.default_rng(7)
    x = list(rng.normal(size=(150, 16)))
    for k in range(40):  # one large group of near copies
        x.append(x[0] + rng.normal(size=16) * 0.05)
    for k in range(60):  # pairs about the threshold
        v = x[10 + k] / np.linalg.norm(x[10 + k])
        o = rng.normal(size=16)
        o -= (o @ v) * v
        angle = math.acos(rng.uniform(0.86, 0.96))
        x.append(3 * (math.cos(angle) * v + math.sin(angle) * o / np.linalg.norm(o)))
    rows = [(int(i), [float(f) for f in v]) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None] * 8), (904, [float("inf")] * 16), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (907, [])]
    rows += [(908, [1e200 * f for f in rows[5][1]]), rows[3], (None, rows[3][1])]
    return rows


def test_embedding_links_match_brute_force(llm):
    rows = vectors()
    usable = {}
    for i, v in rows:
        if i is not None and v and all(f is not None and math.isfinite(f) for f in v) and any(v):
            a = np.array(v) / max(map(abs, v))
            usable[i] = a / np.linalg.norm(a)
    links = [(a, b) for a in usable for b in usable if a < b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.9]
    comp = components = H.components({i for i, _ in rows if i is not None}, links)
    count = Counter(x for pair in links for x in pair)
    table = llm.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, vec int")
    got = embed_dedup.near_duplicates(table, recall=0.99999).collect()
    assert Counter(g["vec_id"] for g in got) == Counter(i for i, _ in rows)
    wrong = [g for g in got if g["vec_id"] is not None and (g["n_links"], g["component_id"]) != (count[g["vec_id"]], comp[g["vec_id"]])]
    assert not wrong and components
    assert all(g["kept"] == (g["vec_id"] is None or g["vec_id"] == g["component_id"]) for g in got)
    assert embed_dedup.near_duplicates(table.limit(0)).count() == 0


def test_large_cells_are_cut_into_blocks(llm, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL", 8)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16) * 2
    x = [centre + rng.normal(size=16) * 0.8 for _ in range(60)]
    unit = [v / np.linalg.norm(v) for v in x]
    want = Counter(k for a in range(60) for b in range(a) if unit[a] @ unit[b] >= 0.9 for k in (a, b))
    table = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(table, recall=0.99999).collect()}
    assert sum(want.values()) > 0 and got == {i: want[i] for i in range(60)}


def test_no_single_projection_rules_a_pair_out():
    import pyarrow as pa

    sketch = np.zeros((3, embed_dedup.SKETCH), np.int8)
    sketch[1, 0] = 100  # far apart in the first projection only
    sketch[2] = 100
    for lo, hi, side in ((0, 0, [0, 0, 0]), (0, 1, [0, 1, 1]), (0, 1, [1, 0, 1])):
        batch = pa.RecordBatch.from_pydict({
            "t": pa.array([0] * 3, pa.int32()), "cell": [5] * 3, "lo": pa.array([lo] * 3, pa.int32()), "hi": pa.array([hi] * 3, pa.int32()),
            "side": pa.array(side, pa.int32()), "ball": [10, 11, 12], "sketch": [x.tobytes() for x in sketch], "r": [0.0] * 3,
        })
        got = [(r["a"], r["b"]) for out in embed_dedup._collisions(math.acos(0.9))([batch]) for r in out.to_pylist()]
        assert got == [(10, 11)]


def test_recall_of_the_registered_settings_near_the_threshold(llm):
    rng = np.random.default_rng(12)
    rows, links = [], 3000
    for k in range(links):  # one pair each; unrelated vectors are far from the threshold
        v, o = rng.normal(size=(2, 64))
        v /= np.linalg.norm(v)
        o -= (o @ v) * v
        cos = rng.uniform(0.9001, 0.93)
        rows += [(2 * k, v.tolist()), (2 * k + 1, (cos * v + math.sqrt(1 - cos * cos) * o / np.linalg.norm(o)).tolist())]
    x = np.array([v for _, v in rows])
    assert (np.triu(x @ x.T, 1) >= 0.9).sum() == links
    got = embed_dedup.near_duplicates(llm.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    found = [g for g in got if g["n_links"]]
    assert all(g["n_links"] == 1 and g["component_id"] == g["vec_id"] // 2 * 2 for g in found)
    assert len(found) >= 0.999 * 2 * links


# ---------------------------------------------------------------- shared parts, pipeline


def test_components_of_a_long_chain_and_a_hub(llm):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 300)] + [(500, 500)]
    got = {r["node"]: r["component"] for r in common.connected_components(llm.createDataFrame(edges, "a long, b long"), "a", "b", "test").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(300)}}


def test_group_facts_reach_hot_and_cold_groups(llm):
    from pyspark.sql import functions as F

    rows = llm.range(5000).select("id", F.when(F.col("id") < 3000, 1).otherwise(F.col("id") % 700).alias("g"))
    facts = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).where("g <> 5")
    got = common.attach_group_facts(rows, facts, ["g"], "n", "id")
    want = {r["g"]: (r["n"], r["least"]) for r in facts.collect()}
    assert all((r["n"], r["least"]) == want.get(r["g"], (None, None)) for r in got.collect()) and got.count() == 5000


def test_pipeline_stages_keep_the_columns(llm):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dup", "decontam", "mixing", "tokens"]
    out = corpus_pipeline.run(llm, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_sql_of_queries(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        got = queries.QUERIES[name](spark, sf)
        want = con.execute(sql)
        cols = [c[0] for c in want.description]
        assert sorted(cols) == sorted(got.columns), name
        plain = lambda row: json.dumps([row[c] for c in sorted(cols)])
        assert Counter(map(plain, got.collect())) == Counter(plain(dict(zip(cols, r, strict=True))) for r in want.fetchall()), name


def test_one_of_each_keeps_unlike_rows_with_one_id(llm, no_docs):
    from dockwise.llm import near_dup

    rng = random.Random(21)
    a, b, c = (H.prose(rng, 60) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "y"), (2, a + " end", "z"), (3, c, "w"), (3, c, "w"), (None, b, "v"), (None, "alone here", "u"), (None, None, "n"), (4, None, "m"), (5, "", "l")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, node string")
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    got = Counter((r["text"] or "").replace(" end", "") for r in kept.collect())
    assert got == Counter([a, b, c, "alone here", "", "", ""])
    assert near_dup.one_of_each(no_docs).collect() == []


def test_components_with_a_hub_spread_it(llm):
    n = 4000
    edges = [(5, 100_000 + i) for i in range(n)] + [(100_000 + n - 1, 3)]
    got = common.connected_components(llm.createDataFrame(edges, "a long, b long"), "a", "b", "test").collect()
    assert len(got) == n + 2 and {r["component"] for r in got} == {3}
