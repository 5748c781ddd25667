"""Operators and stages on small tables with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from pingmotion.llm import bpe, catalogue, decontaminate, near_dedup, pii, quality, token_counts, topk, toxicity, urls, warc
from pingmotion.llm.components import components
from pingmotion.llm.linear import labelled_sample
from pingmotion.sources.scratch import new_folder
from tests.verify_oracles import compare, duck

public_tokenizers = pytest.importorskip("public_tokenizers")

# columns that operators also use inside, and names of their results
EXTRA = "lang string, source string, n_chars long, digest string, key string, `row` long, n long, text_a string"
DOCS = f"doc_id long, text string, {EXTRA}"
_rng = random.Random(11)
_LEXICON = [f"{a}{b}{c}" for a in "bdfkmt" for b in "aeiou" for c in "lnrst"]


def prose(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return [rng.choice(_LEXICON) + rng.choice(_LEXICON) for _ in range(n)]


def table(spark, texts: list[tuple[int | None, str | None]]):
    return spark.createDataFrame([(i, t, "en", "s", 7, "d", "k", 1, 2, "t") for i, t in texts], DOCS)


def edge_texts() -> list[tuple[int | None, str | None]]:
    base = prose(120, 1)
    near = [" ".join(base[:60] + ["changed"] + base[61:])]
    return [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two three four"),
        (9, " ".join(base)), (8, " ".join(base)), (10, near[0]), (7, " ".join(prose(120, 2))),
        (11, "x" * 200_000), (12, " ".join(prose(30_000, 3))), (12, " ".join(prose(30_000, 3))),
        (None, "one"), (None, None), (13, "mail a.b@c.de, 10.0.0.1 and +1 (555) 123-4567 \U0001f600 4111 1111 1111 1111"),
        (14, "\ue000 x@y.zz \ue000"), (15, "a" * 50 + "@" + "b." * 20_000 + "c"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, edge_texts())


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(16)] + [(None, 1, 1), (4, None, None), (4, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def key(row):
    return tuple((v is None, str(v)) for v in row)


# near duplicates


def brute_components(texts: dict[int, str], percent: int) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    name = {i: i for i in sets}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                name[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(groups: int, size: int) -> list[tuple[int, str]]:
    """Groups of copies with more and more edits, exact copies, and lines that many texts share."""
    rng, out, number = random.Random(5), [], 100
    line = prose(13, 99)
    for g in range(groups):
        words = prose(rng.choice([8, 60, 150]), 1000 + g)
        for c in range(rng.randrange(1, size)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(_LEXICON)
            out.append((number, " ".join(line + copy if g % 3 == 0 else copy)))
            number += 1
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(spark, percent):
    texts = near_copies(40, 9)
    got = near_dedup.near_duplicates(table(spark, texts).repartition(5), percent).collect()
    want = brute_components(dict(texts), percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_keys_lose_no_link(spark, monkeypatch):
    """With tiny limits nearly all links are found by pivots and blocks."""
    monkeypatch.setattr(near_dedup, "KEY_ROUNDS", 0)
    rng, words, texts = random.Random(3), prose(100, 77), []
    for i in range(90):
        copy = list(words)
        for _ in range(rng.randrange(0, 5)):
            copy[rng.randrange(100)] = rng.choice(_LEXICON) * 2
        texts.append((i, " ".join(copy)))
    got = near_dedup.near_duplicates(table(spark, texts), 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(dict(texts), 85)


def test_near_duplicates_edges(spark, docs):
    rows = {}
    for r in near_dedup.near_duplicates(docs, 85).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, rows.values())) == len(edge_texts())
    for i in (1, 2, 3):
        assert rows[i][0]["n_shingles"] == 0 and rows[i][0]["component_id"] == i
    assert rows[5][0]["component_id"] == 4 and not rows[5][0]["kept"]
    assert [rows[i][0]["component_id"] for i in (8, 9, 10)] == [8, 8, 8]
    assert len(rows[12]) == 2 and all(r["kept"] for r in rows[12])
    assert all(r["kept"] for r in rows[None])
    assert near_dedup.near_duplicates(docs.limit(0), 85).count() == 0


@pytest.mark.parametrize("few", [0, 1 << 18])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr("pingmotion.llm.components.ONE_TASK_EDGES", few)
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


# trained operators


def test_folds(spark):
    ids = [0, 1, 17, 123456789012]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(catalogue.fold(F.col("doc_id"), 5)).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 5 for i in ids]


def test_quality_on_held_out_labels(spark, sf_dir):
    rows = {r["doc_id"]: r for r in queries()["op2_quality"](spark, sf_dir.replace("0.001", "0.1")).collect()}
    marks = spark.read.parquet(sf_dir.replace("0.001", "0.1") + "/labels.parquet").collect()
    held = [(rows[m["doc_id"]]["predicted"], m["quality"]) for m in marks if rows[m["doc_id"]]["held_out"]]
    assert len(held) > 500 and sum(p == q for p, q in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_toxicity_on_held_out_labels(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.1")
    rows = {r["doc_id"]: r for r in queries()["op6_toxicity"](spark, sf).collect()}
    held = [(rows[m["doc_id"]]["predicted"], m["toxic"]) for m in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[m["doc_id"]]["held_out"]]
    toxic = [p for p, t in held if t]
    clean = [p for p, t in held if not t]
    # a seventh of the toxic labels of this table stand on texts without a toxic word
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.02 * len(clean)


@pytest.mark.parametrize("module, score", [(quality, quality.quality_scores), (toxicity, toxicity.toxic_spans)])
def test_trained_operators_edges(spark, docs, labels, module, score):
    model = module.train(docs, labels)
    got = score(docs, model, docs.columns)
    assert sorted(map(key, got.select(*docs.columns).collect())) == sorted(map(key, docs.collect()))
    value = {r["doc_id"]: r[len(docs.columns)] for r in got.collect()}
    assert all(0 <= v <= 1 for v in value.values())
    assert value[1] == value[2] == value[3]
    none = module.train(docs.limit(0), labels.limit(0))
    assert score(docs, none).count() == docs.count() and score(docs.limit(0), none).count() == 0


def test_sample_has_one_row_per_id(spark):
    docs = table(spark, [(i % 7, f"text {i}") for i in range(400)] + [(0, f"busy {i}") for i in range(400)])
    labels = spark.createDataFrame([(i % 7, i % 2) for i in range(50)], "doc_id long, quality int")
    held = -1  # no fold
    got = labelled_sample(docs, labels, "quality", 5, held, 1000).select("doc_id", "text", "y").collect()
    assert sorted((r["doc_id"], r["text"], r["y"]) for r in got) == [(0, "busy 0", 0)] + [(i, f"text {min(f'{j}' for j in range(i, 400, 7))}", 0) for i in range(1, 7)]


def test_toxic_offsets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(prose(40, i) + (["scumbag"] if i % 2 else []) + prose(5, -i))) for i in range(400)]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    found = toxicity.toxic_spans(docs, toxicity.train(docs, labels), ["doc_id", "text"]).collect()
    for r in rng.sample(found, 50):
        if r["doc_id"] % 2:
            assert any("scumbag" in r["text"][s["start"] : s["end"]] for s in r["spans"]) and r["toxicity"] > 0.5
        else:
            assert not r["spans"] and r["toxicity"] < 0.5


# personal data

FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text: str | None) -> str:
    out = []
    for number, (kind, pattern) in enumerate(FIXED.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits)))
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and doubled % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), number, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(12)
    texts = [t for _, t in edge_texts()]
    for alphabet in ("a@.b-_ ", "0125. ", "4 -01", "+1 ().-29a", "a1@.+ 4-é\U0001f600\ue000"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.choice([5, 20, 60]))) for _ in range(150)]
    texts += ["4111111111111111" * k for k in (1, 2)] + ["1.2.3.4.5.6.7.8", "999.1.1.1.5.6.7", "0255.1.1.00001", "a@b.c_d@e.f"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = pii.private_spans(table(spark, rows), ["doc_id", "text"]).select("text", pii.span_text(F.col("base")).alias("b"))
    assert all(r["b"] == plain_base(r["text"]) for r in got.collect())
    assert got.count() == len(rows)


def test_disclosing_terms(spark):
    """A name that stands only with one address discloses it; a word that stands everywhere does not."""
    rows = [(i, f"{' '.join(prose(30, i))} write to Quimby at boss@firm.com before noon") for i in range(6)]
    rows += [(100 + i, " ".join(prose(40, 50 + i)) + " before noon") for i in range(60)]
    found = pii.private_spans(table(spark, rows), ["doc_id", "text"])
    got = found.select("doc_id", "text", "base", "spans", pii.redacted(F.col("text"), F.col("spans")).alias("clean")).collect()
    for r in got:
        terms = [s["value"] for s in r["spans"] if s["kind"] == "term"]
        assert all(r["text"][s["start"] : s["end"]].lower() == s["value"].lower() for s in r["spans"])
        if r["doc_id"] < 100:
            assert "quimby" in terms and "before" not in terms and "noon" not in terms
            assert len(r["base"]) == 1 and "[TERM]" in r["clean"] and "[EMAIL]" in r["clean"] and "boss" not in r["clean"]
        else:
            assert not r["spans"] and r["clean"] == r["text"]


def test_disclosing_terms_anywhere(spark):
    """A name far from the address discloses it, and is marked everywhere, also without the address."""
    far = lambda i: " ".join(prose(120, 700 + i))
    rows = [(i, f"Quimby {far(i)} reach us at boss@firm.com, says QUIMBY") for i in range(6)]
    rows += [(i, f"Dear Vandermeer, {far(i)} boss@firm.com") for i in range(6, 10)]
    rows += [(10, f"{far(10)} Vandermeer alone and again vandermeer"), (11, "vandermeer@else.org only")]
    rows += [(100 + i, far(100 + i) + " reach us, says dear") for i in range(5000)]
    found = pii.private_spans(table(spark, rows), ["doc_id", "text"]).where("doc_id < 12 OR size(spans) > 0").collect()
    assert {r["doc_id"] for r in found} == set(range(12))
    for r in found:
        terms = [s for s in r["spans"] if s["kind"] == "term"]
        assert all(r["text"][s["start"] : s["end"]].lower() == s["value"] for s in terms)
        name = "quimby" if r["doc_id"] < 6 else "vandermeer"
        times = {10: 2, 11: 0}.get(r["doc_id"], 2 if r["doc_id"] < 6 else 1)
        assert [s["value"] for s in terms] == [name] * times


def test_private_spans_edges(spark, docs):
    got = pii.private_spans(docs, docs.columns)
    assert sorted(map(key, got.select(*docs.columns).collect())) == sorted(map(key, docs.collect()))
    assert pii.private_spans(docs.limit(0)).count() == 0


# search


def test_top_k_edges(spark):
    nan = float("nan")
    rows = [(0, [0.5, 0.25]), (50, [-0.5, -0.5]), (50, [-0.5, -0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [1.0]),
            (5, [0.5, 0.25]), (6, [0.5, 0.25]), (None, [1.0, 1.0]), (7, []), (100, [0.0, 0.0]), (8, [0.1, 0.2, 0.3])]
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, block int")
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0, 3).collect()
    part = [(i, [int(256 * x // 1) for x in v]) for i, v in rows if i is not None and v and None not in v and nan not in v]
    part = [(i, w) for i, w in part if i != 3]
    want = set()
    for q, w in {i: w for i, w in part if i % 50 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(w, x)), i) for i, x in part if i != q)[:3]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)}
    assert {tuple(r) for r in got} == want
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_equals_sql(spark, sf_dir):
    assert compare(spark, duck(sf_dir), "op4_top_k", sf_dir) is None
    assert "op4_top_k" in oracle_sql()


# tokens


def test_encode_decode_edges(spark, docs):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    got = bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN, docs.columns).collect()
    assert len(got) == len(edge_texts())
    for r in got:
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and (len(r["ids"]) > 0) == bool(r["text"])


def test_token_counts_and_cache(spark, docs):
    from tokenizers import Tokenizer

    path, cache = public_tokenizers.path("byte_bpe_50k.json"), new_folder(spark, "cache")
    library = Tokenizer.from_file(path)
    texts = docs.union(table(spark, [(20, "<|endoftext|> and"), (21, "one")]))
    want = sorted(
        (i is None, i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for i, t in texts.select("doc_id", "text").collect()
    )
    for turn in range(2):  # the second time everything comes from the cache
        got = token_counts.token_counts(texts, path, cache).collect()
        assert sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in got) == want
        rows = spark.read.parquet(cache).count()
        assert rows == spark.read.parquet(cache).select("digest").distinct().count(), turn
    assert token_counts.token_counts(texts.limit(0), path, new_folder(spark, "cache")).count() == 0


def test_words_are_counted_once_and_add_up_to_the_text(monkeypatch, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_counts.counted_by_word(path)
    library, counter = Tokenizer.from_file(path), token_counts.Counter(path, True)
    rng = random.Random(7)
    parts = [" ", " ", "  ", "\n", "\n\n", "\t", "\u00a0", "\u3000", "\u200b", "\u180e", "\x1c", "\x85", "word", "New", "'s", "'t",
             "7", "\u0663", "ß", "e\u0301", "字", "😀", "<|endoftext|>", "<|endo", ".", ",", "!?", "-", "\ufeff", "w" * 90]
    texts = ["", *("".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(4000))]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.counts(texts) == want == token_counts.Counter(path, False).counts(texts)
    monkeypatch.setattr(token_counts, "REMEMBERED", 20)
    assert [n for t in texts[:300] for n in counter.counts([t])] == want[:300]
    # known words do not go to the library again
    counter.counts(["a new word, here"])
    monkeypatch.setattr(token_counts, "REMEMBERED", 1 << 19)
    sent = []
    monkeypatch.setattr(counter, "_library", lambda words: sent.extend(words) or [1] * len(words))
    counter.counts(["a new word, here and new there"])
    assert sorted(sent) == [" and", " there"]


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
    {"added_tokens": [{"id": 50256, "content": "a b", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}]},
    {"added_tokens": [{"id": 50256, "content": "<x>", "single_word": False, "lstrip": True, "rstrip": False, "normalized": False, "special": True}]},
])
def test_other_vocabularies_get_whole_texts(tmp_path, change):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = json.load(f)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(vocabulary | change), encoding="utf-8")
    assert not token_counts.counted_by_word(str(path))


# archives


def test_archives(spark):
    rows = [(3, "http://a", "<p>"), (1, "http://b", "<p>"), (2, None, "é" * 400_000), (5, "u", None), (4, "v", ""), (None, "w", "<p>"),
            (1, "http://b", "<p>"), (None, "x", "only"), (9, "two\r\nlines", "\r\n\r\nWARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, first_id int")
    bundles = warc.write_bundles(pages)
    got = warc.read_bundles(bundles).collect()
    want = []
    for page, _, html in rows:
        payload = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(ids, default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = page != first
        want.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    entry = bundles.select("bundle_bytes", F.explode("index").alias("e")).where("e.page_id = 2").first()
    e = entry["e"]
    record = warc.read_record(bytes(entry["bundle_bytes"]), e["frame"], e["offset"], e["length"])
    assert warc.parse_record(record)[1].decode() == "é" * 400_000
    assert warc.read_bundles(warc.write_bundles(pages.limit(0))).count() == 0


# decontamination


def test_leaks(spark, docs, monkeypatch):
    items = [(i, " ".join(prose(30, 500 + i))) for i in range(40)] + [(90, None), (91, ""), (None, "a b"), (92, "?!")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    planted = []
    for i in range(40):
        words = items[i][1].upper().replace(" ", ", ").split()
        if i % 2:
            words[i % 30] = "other"
        planted.append((1000 + i, " ".join(prose(50, 900 + i) + words + prose(50, 950 + i))))
    all_docs = docs.union(table(spark, planted))
    found = {(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.leaks(all_docs, bench).collect()}
    assert found == {(1000 + i, i, i % 2) for i in range(40)}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)  # several passes find the same
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.leaks(all_docs, bench).collect()} == found
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.leaks(all_docs, bench.limit(0)).count() == 0


def test_short_leaks(spark):
    """Items of any length are found inside longer texts, each once at its first place; a changed or cut copy of a
    short item, or one that runs over the end of a text, is none."""
    items = [(n, " ".join(f"item{n}w{i}" for i in range(n))) for n in range(1, 13)] + [(50, "item3w0 item3w1 item3w2"), (51, "twice twice")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    there = []
    for n, text in items[:12]:
        there.append((n, " ".join(prose(20, n)) + f" {text.upper().replace(' ', ', ')}. {text} " + " ".join(prose(20, 60 + n))))
        if 1 < n < 10:
            there.append((100 + n, " ".join(prose(20, n) + text.split()[:-1] + ["other"] + prose(20, 60 + n))))
            there.append((200 + n, " ".join(prose(20, n) + text.split()[:-1])))
            there.append((300 + n, text.split()[-1]))
    there += [(400, "twice twice twice"), (401, "twice")]
    got = decontaminate.leaks(table(spark, there), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted([(n, n) for n in range(1, 13)] + [(3, 50), (400, 51)])
    texts = dict(there)
    for r in got:
        want = dict(items)[r["item_id"]].split()
        found = texts[r["doc_id"]][r["start"] : r["end"]]
        assert found.lower().replace(",", "").split() == want and texts[r["doc_id"]].index(found) == r["start"]
        assert (r["edits"], r["item_words"]) == (0, len(want)) and (r["doc_id"] == 400 or found.isupper())
    loose = decontaminate.leaks(table(spark, there), bench, 0.4).collect()  # edits in short items take nothing away
    assert {(r["doc_id"], r["item_id"]) for r in got} <= {(r["doc_id"], r["item_id"]) for r in loose}


# urls


def test_suffix_rates_cover_all_rows_whatever_the_sample(spark):
    hosts = ["a.net", "b.net", "example.net", "x.org", "y.org", "de.example.com"]
    rows = [(i, f"http://{hosts[i % 6]}/{['en', 'fr', 'de'][i % 7 % 3]}/{i}") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    plain: dict[str, list[int]] = {}
    labelled = 0
    for r in urls.judged(pages, catalogue.URL_RULES, urls.train(pages, catalogue.URL_RULES)).where("rule IS NOT NULL").collect():
        labelled += 1
        for n in (1, 2):
            plain.setdefault(f"{n} " + ".".join(r["host"].split(".")[-n:]), []).append(int(r["verdict"] == "block"))
    prior = (sum(v for k, x in plain.items() if k[0] == "1" for v in x) + 1) / (labelled + 2)
    for bound in (10, 20_000):
        rates, got_prior, _, trees = urls.train(pages, catalogue.URL_RULES, bound)
        assert got_prior == pytest.approx(prior) and trees
        got = {r["suffix"]: r["rate"] for r in rates.collect()}
        assert got == pytest.approx({k: (sum(v) + 5 * prior) / (len(v) + 5) for k, v in plain.items()})
    # repeated rows change nothing
    once = sorted(map(tuple, urls.judged(pages, catalogue.URL_RULES, urls.train(pages, catalogue.URL_RULES, 50)).collect()))
    more = pages.union(pages.withColumn("page_id", F.col("page_id") + 1000))
    twice = urls.judged(more, catalogue.URL_RULES, urls.train(more, catalogue.URL_RULES, 50)).where("page_id < 1000")
    assert sorted(map(tuple, twice.collect())) == once


def test_url_rules(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "no scheme": ("", "", None), "http://A.Net": ("a.net", "", None),
        "http://A.Net/": ("a.net", "/", "net/"), "x://example.net/en/1?q": ("example.net", "/en/1", "example.net/en/"),
        "x://www.example.net/en": ("www.example.net", "/en", "net/"), "x://notexample.net/en/": ("notexample.net", "/en/", "net/"),
        "https://b.example.com/de/x#f": ("b.example.com", "/de/x", "example.com/de/"), "a://é.org/fr/": ("é.org", "/fr/", "org/fr/"),
        "a://x?u=b://y.net/": ("x", "", None), "a://net/": ("net", "/", "net/"), "a://ÉX.NET/\n/": ("Éx.net", "/\n/", "net/"),
        "a://x.org#/fr/": ("x.org", "", None), "a://": ("", "", None),
    }
    verdicts = {h + p: act for act, h, p in catalogue.URL_RULES}
    rows = [(i, u, "h", "p") for i, u in enumerate([*cases, *cases])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string")
    model = urls.train(pages, catalogue.URL_RULES)
    got = urls.judged(pages, catalogue.URL_RULES, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"]) == cases[r["url"]], r
        assert r["verdict"] == verdicts[r["rule"]] if r["rule"] else r["verdict"] in ("allow", "block")
    assert urls.judged(pages.limit(0), catalogue.URL_RULES, urls.train(pages.limit(0), catalogue.URL_RULES)).count() == 0


# pipeline


def test_stages(spark, docs, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf_dir)
        rows = got.collect()
        if name != names[-1]:
            assert got.columns == docs.columns
        if name in names[3:]:
            assert len(rows) == len(edge_texts())
        assert stage(spark, empty, sf_dir).count() == 0
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()}
    assert kept == {1, 2, 3, 4, 6, 7, 8, 11, 12, 13, 14, 15, None}


def test_leaks_of_rows_without_id(spark, sf_dir):
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 50").orderBy("item_id").first()["text"]
    rows = [(None, f"before {passage} after"), (None, "clean"), (None, None), (1, passage), (2, "clean"), (None, "clean")]
    got = corpus_pipeline.drop_leaks(spark, table(spark, rows), sf_dir)
    left = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert sorted(left, key=key) == sorted([(None, "clean"), (None, "clean"), (None, None), (2, "clean")], key=key)


def test_pipeline_takes_effect(spark, sf_dir):
    sf = sf_dir
    rows = queries()["pipeline"](spark, sf).collect()
    there = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = [r["doc_id"] for r in rows]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < len(there)
    leaking = {r["doc_id"] for r in queries()["op9_leaks"](spark, sf).collect()}
    assert not leaking & set(ids)
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in rows:
        text = library.decode(r["ids"])
        assert not plain_base(text)
        if not re.search(r"\[(EMAIL|IP|CARD|PHONE|TERM)\]", text):
            assert text == there[r["doc_id"]]
