"""Packing, collocations and spelling variants against brute force, on awkward rows and on the smallest tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from spindrel.llm import packing, phrases, queries, spelling

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, grp string, size int, word string, n long, near string, phrase string"


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


def awkward():
    r = random.Random(7)
    prose = lambda n, v: " ".join(f"{'aeiou'[r.randrange(5)]}word{chr(97 + r.randrange(v))}" for _ in range(n))
    rows = [
        (1, "New York, New York! new york; City of new york", "en"), (2, None, "en"), (3, "", None), (4, " \t\r\n ", "fr"), (5, "one", "en"),
        (6, "new york " * 60, "en"), (6, "new york " * 60, "en"), (None, "a b c d e f. " * 50, None), (None, None, None), (8, prose(9000, 20), "de"),
        (9, "École éCOLE ÉCOLE ×÷×÷×÷ straße STRASSE naïveté " * 8, "fr"), (10, "x" * 5000 + " " + "y" * 70, "en"), (11, "receive recieve receives Receive " * 9 + "recei1ve", "en"),
        (12, "letter lettter leter better letters " * 7, "en"), (13, "letter " * 80 + "don't '' I'LL <|endoftext|> ﬁ é 　 日本語 ４5 😀", "en"), (14, "letter\x1cletter\x85letter\xa0letter", "en"),
    ]
    return [(i, t, lang, "g", 1, "w", 2, "n", "p") for i, t, lang in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


# ---- packing


def check_packing(got, rows, length=2048):
    """Every id in exactly one piece, sequences without gaps; returns the padding and all tokens."""
    model = tokenizers.Tokenizer.from_file(PATH)
    wanted = Counter()
    for i, t, *_ in rows:
        wanted[i, (*model.encode(t or "", add_special_tokens=False).ids, 1)] += 1
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = tuple(np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist())
        assert len(ids) == r["length"] > 0
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for (i, n), own in pieces.items():
        whole = Counter({ids: c for (j, ids), c in wanted.items() if j == i and len(ids) == n})
        by_start = defaultdict(list)
        for s, ids in sorted(own):
            by_start[s].append(ids)
        for ids, c in whole.items():
            for _ in range(c):  # repeated rows may be cut differently: any chain of pieces will do
                at = 0
                while at < n:
                    k = next(k for k, p in enumerate(by_start[at]) if p == ids[at : at + len(p)])
                    at += len(by_start[at].pop(k))
        assert not any(by_start.values())
    assert {(i, len(ids)) for i, ids in wanted} == set(pieces)
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & at - 1 == 0 else length - at
    return padding, sum(r["length"] for r in got)


def test_packing_awkward(spark, docs):
    got = packing.pack(docs, PATH).collect()
    padding, _ = check_packing(got, awkward())
    assert padding < packing.LEAST * len(got)
    check_packing(packing.pack(docs, PATH, length=64).collect(), awkward(), 64)
    assert packing.pack(docs.limit(0), PATH).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, length=1000)


def test_packing_query(spark, rows):
    got = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), PATH).collect()
    padding, tokens = check_packing(got, rows)
    assert padding < 0.005 * tokens
    told = queries.op11_packing(spark, SF).collect()
    key = lambda r: (r["sequence_id"], r["offset"])
    for a, b in zip(sorted(got, key=key), sorted(told, key=key), strict=True):
        assert zlib.crc32(bytes(a["ids"])) == b["ids_crc32"] and a["doc_tokens"] == b["doc_tokens"]


def test_first_fit_by_plain_search():
    r = random.Random(3)
    for _ in range(200):
        sizes = sorted((r.randrange(1, 65) for _ in range(r.randrange(120))), reverse=True)
        free, wanted = [], []
        for s in sizes:
            b = next((i for i, f in enumerate(free) if f >= s), len(free))
            if b == len(free):
                free.append(64)
            free[b] -= s
            wanted.append(b)
        assert packing.first_fit(sizes, 64) == wanted
        cut = packing.packed(sizes, 64, least=4)
        assert sorted((i, x) for b in cut for i, s, e in b for x in range(s, e)) == [(i, x) for i, s in enumerate(sizes) for x in range(s)]
        full = [sum(e - s for _, s, e in b) for b in cut]
        assert all(f > 60 or f & f - 1 == 0 for f in full) and max(full, default=0) <= 64


def test_groups_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_BYTES", 4000)
    rows = [(i, "same words again " * 40, "en") for i in range(200)] + [(7, "same words again " * 40, "en")] * 100
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), PATH).collect()
    check_packing(got, rows)
    assert len({r["sequence_id"] >> 32 for r in got}) > 20


def test_ids_of_words_are_those_of_texts():
    spec = open(PATH, encoding="utf-8").read()
    code, model = packing.Encoder(spec), tokenizers.Tokenizer.from_file(PATH)
    r = random.Random(5)
    signs = "aZé'0 <|>×́İΣß-.$ \n\t\xa0's'll"
    for text in ["".join(r.choice(signs) for _ in range(60)) for _ in range(1500)]:
        assert code.ids(text).tolist() == model.encode(text, add_special_tokens=False).ids
    assert code.apart
    code.held = packing.REMEMBERED + 1
    assert code.ids("forget it all").tolist() == model.encode("forget it all", add_special_tokens=False).ids and code.held < 10_000


# ---- collocations


def brute_collocations(rows, least=100, longest=5, percent=100, top=2000):
    total, f = Counter(), Counter()
    for _, t, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    found = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    inside = set()
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * a >= percent * f[lang, w[i : i + m]]:
                    inside.add((lang, w[i : i + m]))
    out = defaultdict(list)
    for (lang, w), a in found.items():
        if (lang, w) not in inside:
            cuts = [(1000 * a * total[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, n, p.decode(), -a, x, y, total[lang], -s) for lang, own in out.items() for n, (s, a, p, x, y) in enumerate(sorted(own)[:top], 1))


def told(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("least", "longest", "percent", "top"), [(100, 5, 100, 2000), (5, 3, 80, 4), (2, 5, 100, 2000), (1, 2, 100, 2000)])
def test_collocations_awkward(docs, least, longest, percent, top):
    got = told(phrases.collocations(docs, least=least, longest=longest, percent=percent, top=top))
    assert got == brute_collocations(awkward(), least, longest, percent, top) and got


def test_collocations_small_sketch_and_chunks(docs, monkeypatch):
    """A sketch whose cells are all shared, texts cut into chunks, a count beyond 15 bits."""
    monkeypatch.setattr(phrases, "CHUNK", 64)
    monkeypatch.setattr(phrases, "HALF", 37)
    assert told(phrases.collocations(docs, least=30)) == brute_collocations(awkward(), 30)
    assert told(phrases.collocations(docs, least=60)) == brute_collocations(awkward(), 60)


def test_collocations_empty_and_exact(spark, docs):
    assert told(phrases.collocations(docs.limit(0))) == [] and told(phrases.collocations(docs.where("text is null"))) == []
    big = spark.createDataFrame([("en", 0, None, 10**13), ("en", 1, "a", 3 * 10**12), ("en", 1, "b", 10**12), ("en", 2, "a b", 10**12)], "lang string, size int, phrase string, n long")
    phrases_of = phrases.frequent_phrases
    try:
        phrases.frequent_phrases = lambda docs, **_: big
        assert told(phrases.collocations(docs)) == [("en", 1, "a b", 10**12, 3 * 10**12, 10**12, 10**13, 1000 * 10**13 // (3 * 10**12))]
    finally:
        phrases.frequent_phrases = phrases_of


def test_collocations_query(spark, rows):
    assert told(queries.op12_collocations(spark, SF)) == brute_collocations(rows)


# ---- spelling


def brute_variants(rows, shortest=6, least=5, times=5, rate=199):
    count = Counter()
    for i, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % rate == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= shortest and n >= least}
    holes = defaultdict(set)  # words by what a deletion, or a hole in a letter's place, makes of them
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
            holes[w[:i] + w[i + 1 :]].add(w)
        holes[w].add(w)
    near = defaultdict(set)
    for key, own in holes.items():
        for a in own:
            for b in own:
                if a != b and ("\0" in key or key in (a, b)):
                    near[a].add(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def spelled(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_variants_awkward(docs):
    got = spelled(spelling.variants(docs))
    assert got == brute_variants(awkward()) and any(r[1] for r in got)
    assert spelled(spelling.variants(docs, shortest=2, least=1, times=2, rate=3)) == brute_variants(awkward(), 2, 1, 2, 3)
    assert spelled(spelling.variants(docs.limit(0))) == [] and spelled(spelling.variants(docs.where("text is null"))) == []


def test_variants_slices_and_blocks(docs, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 10)
    monkeypatch.setattr(spelling, "PLACES", 3)
    monkeypatch.setattr(spelling, "HELD", 4)
    assert spelled(spelling.variants(docs, least=1)) == brute_variants(awkward(), least=1)


def test_neighbourhood_is_full_and_distinct():
    for word in ("letter", "aaaaab", "ß", "abcabc"):
        letters = "abeltrß"
        wanted = {word[:i] + word[i + 1 :] for i in range(len(word))}
        wanted |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters} - {word}
        wanted |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        got = spelling.neighbours(word, letters)
        assert len(got) == len(set(got)) and set(got) == wanted


def test_chains_are_followed(spark):
    names = ["letters", "lettere", "letterea", "lettereas"]
    rows = [(i, " ".join([w] * n), "en") for i, (w, n) in enumerate(zip(names, (700, 130, 26, 5), strict=True))]
    got = {r[0]: r[1:] for r in spelled(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rate=10**9))}
    assert {w: got[w][1] for w in names} == dict.fromkeys(names, "letters") and got["lettereas"][0] == "letterea"


def test_variants_query(spark, rows):
    assert spelled(queries.op13_spelling_variants(spark, SF)) == brute_variants(rows)
