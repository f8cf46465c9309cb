"""The training-data operators against brute force, and on the rows that break things."""
import base64
import bz2
import collections
import gzip
import hashlib
import lzma
import os
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from quern.llm import ann, audit, chunks, hmm, langid, mixing, packing, secrets, simhash, substrings, toxicity, urls, variants
from quern.llm.queries import QUERIES, URL_RULES, tokenizer_path
from quern.session import stage

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")

ODD = [
    (3, "the cat sat on the mat and the dog ran off", "b", "en"),
    (3, "the cat sat on the mat and the dog ran off", "b", "en"),
    (1, None, None, None),
    (2, "", "a", "en"),
    (None, "Ünïcödé 😀 words here", "b", "de"),
    (7, "word " * 9000, "a", "en"),
    (8, "a\tb\x0bc\x1cd\u00a0e", "a", None),
]
SCHEMA = "doc_id long, text string, source string, lang string"
CLASHING = ["fp", "group", "row", "rank", "length", "token", "c", "size", "_id", "toxic", "place", "block", "extra"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({n: F.lit("clash") for n in CLASHING})


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# 1 language-model scores


@needs_tables
def test_scores(spark, texts):
    found = by_id(QUERIES["op1_hmm_scores"](spark, SF))
    tokens = {i: t.encode().lower().split() + [b" "] for i, t in texts.items()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    c = collections.Counter(w for i in train for w in tokens[i])
    below = np.log10(sum(c.values()) + 0.5 * (len(c) + 1))
    better = []
    for i, words in tokens.items():
        row = found[i]
        assert row["held_out"] == (i not in set(train)) if i < 20 else True
        assert (row["n_tokens"], row["train_tokens"]) == (len(words), sum(c.values()))
        assert row["n_known"] == sum(c[w] > 0 for w in words)
        assert row["base_score"] == pytest.approx(sum(np.log10(c[w] + 0.5) - below for w in words))
        if row["held_out"]:
            better.append(row["score"] > row["base_score"])
    assert np.mean(better) > 0.95


def test_forward_and_expected_counts_are_those_of_all_paths():
    rng = np.random.default_rng(0)
    model = hmm.Hmm(rng.dirichlet([1, 1]), rng.dirichlet([1, 1], 2), rng.dirichlet(np.ones(hmm.SYMBOLS), 2))
    sequences = [np.array(s, dtype=np.uint8) for s in ([0, 3, 1, 3], [2, 2], [5])]
    logs, first, step = [], np.zeros(2), np.zeros((2, 2))
    for s in sequences:
        paths = {}
        for path in np.ndindex(*(2,) * len(s)):
            p = model.start[path[0]] * model.emit[path[0], s[0]]
            for a, b, x in zip(path, path[1:], s[1:], strict=False):
                p *= model.step[a, b] * model.emit[b, x]
            paths[path] = p
        total = sum(paths.values())
        logs.append(np.log10(total))
        for path, p in paths.items():
            first[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                step[a, b] += p / total
    assert hmm.likelihoods(model, sequences) == pytest.approx(logs)
    found = hmm.expected(model, sequences)
    assert found[0] == pytest.approx(first) and found[1] == pytest.approx(step)
    assert found[2].sum() == pytest.approx(7) and found[2][:, 3].sum() == pytest.approx(2)


def test_token_probabilities_add_up_within_classes(spark):
    counts = spark.createDataFrame([(b"abc", 5), (b"xbc", 2), (b"q", 1)], "token binary, c long")
    known = hmm.vocabulary(counts, head_tokens=1)
    assert known.counts == {b"abc": 5} and known.total == 8 and known.distinct == 3
    k = hmm.class_of(b"xbc")
    assert (10 ** (np.log10([2.5, 0.5]) - known.class_constants()[k])).sum() == pytest.approx(1)


def test_score_odd_rows(odd, none):
    found = hmm.score_texts(odd, F.col("doc_id") == 7).collect()
    assert len(found) == len(ODD) and all(np.isfinite(r["score"]) for r in found)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (1, 2)} == {1}
    assert hmm.score_texts(none, F.lit(False)).collect() == []
    assert hmm.score_texts(odd, F.lit(True)).where("train_tokens = 0").count() == len(ODD)


# 2 fingerprints


@needs_tables
def test_fingerprints(spark, texts):
    found = by_id(QUERIES["op2_chunk_fingerprints"](spark, SF))
    order = sorted(texts, reverse=True)
    prints = {}
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        moved = len(texts[a]) // 3
        text = texts[a][: len(texts[a]) - moved] + texts[b][:moved]
        assert found[a]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        mine, other = (chunks.parse_fingerprint(found[x]["fingerprint"]) for x in (a, b))
        assert found[a]["near_next"] == chunks.containment(mine, other)
        assert prints.setdefault(texts[a], found[a]["fingerprint"]) == found[a]["fingerprint"]
    assert np.median([r["near_edited"] for r in found.values()]) > 0.6


def test_chunks_cover_texts_and_survive_shifts():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 20000, dtype=np.uint8))
    ends, shifted = chunks.chunk_ends([text, b"xyz" + text])
    assert ends[-1] == len(text) and max(np.diff([0, *ends])) <= chunks.MOST
    whole, moved, alone = chunks.chunk_sets([text, b"xyz" + text, text])
    assert chunks.containment(whole, moved) > 0.98 and whole == alone


def test_fingerprint_odd_rows(odd, none):
    rows = chunks.compare_edits(odd).collect()
    assert len(rows) == len(ODD)
    assert all(r["fingerprint"] == "" and r["n_chars"] == 0 for r in rows if r["doc_id"] in (1, 2))
    twins = [r["near_next"] for r in rows if r["doc_id"] == 3]
    assert 1.0 in twins
    assert chunks.compare_edits(none).collect() == []
    assert chunks.compare_edits(odd.where("doc_id = 2")).first()["near_next"] == 1.0
    assert chunks.fingerprints(odd).count() == len(ODD)


# 3 URL filters


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(x) for x in "/?#" if x in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(x) for x in "?#" if x in rest], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    "http://EXAMPLE.com/en/a/b?x=/es/", "https://www.example.com/en/", "http://example.com/en", "http://xexample.com/en/1",
    "ftp://a.net/es/1#://", "net/es/", "http://net", "http://a.net/fr/?", "x://y://com/", "http://com//", None, "", "://", "http://É.com/en/",
]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_urls(spark, limit):
    rows = [(i % 9, u) for i, u in enumerate(URLS + URLS)] + [(None, URLS[0])] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({n: F.lit(1) for n in ("host", "short", "k", "path")})
    rules = spark.createDataFrame(URL_RULES + [("com", "/", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    found = urls.judge_urls(pages, rules, broadcast_bytes=limit)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(i, *judged(u, URL_RULES)) for i, u in rows], key=repr)
    assert urls.judge_urls(pages.limit(0), rules).collect() == []
    assert urls.judge_urls(pages, rules.limit(0), otherwise="block").where("verdict <> 'block' or rule is not null").isEmpty()


# 4 packing


@needs_tables
@pytest.mark.parametrize("kept", [400_000, 3])
def test_word_ids_are_those_of_the_whole_text(monkeypatch, kept):
    monkeypatch.setattr(packing, "CACHED_WORDS", kept)
    words = packing.WordIds(tokenizer_path())
    batches = [
        ["It's 12,000.5 $$$ don't, end.", "a<|endoftext|>b <|endoftext|> x<|endoftext| <|endo", ""],
        ["\u00dcn\u1e2fcode\u0301 \u2603 \u00a0x a\u00a0b", "end. It's\tnew\n<|startoftext|>", "\u2028 y"],
        ["It's 12,000.5 again", "word word. word, wordy"],
    ]
    for batch in batches * 2:
        for text, ids in zip(batch, words.of([t.encode() for t in batch]), strict=True):
            assert ids.tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    encoded = {i: e.ids + [1] for i, e in zip(texts, tokenizer.encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    bins, seen = collections.defaultdict(list), collections.Counter()
    for r in rows:
        part = encoded[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 4096 * r["piece"] and len(part) == r["length"]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]] += len(part)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert seen == {i: len(e) for i, e in encoded.items()}
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= 1.01 * sum(seen.values()) / 4096 + 1


def test_two_pieces_replace_the_shortest():
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10) == [([6, 2, 2], 1), ([3], 1)]
    for seed in range(20):
        rng = np.random.default_rng(seed)
        counts = {int(k): int(n) for k, n in zip(rng.choice(np.arange(1, 51), 12, replace=False), rng.integers(1, 2000, 12), strict=True)}
        bins = packing.best_two_fit(counts, 50)
        used = collections.Counter()
        for lengths, times in bins:
            assert sum(lengths) <= 50
            used.update({k: n * times for k, n in collections.Counter(lengths).items()})
        assert used == counts and len(bins) < 200


def test_pack_odd_rows(odd, none):
    rows = packing.pack(odd, tokenizer_path(), room=64).collect()
    assert sum(r["start"] == 0 for r in rows) == len(ODD)
    assert {r["length"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert packing.pack(none, tokenizer_path()).collect() == []


def test_word_ids_are_those_of_whole_texts():
    from tokenizers import Tokenizer

    some = ["It's <|endoftext|>x <|STARTOFTEXT|> 12,5!", "İstanbul ΣΑΣ e\u0301", "a\u3000b \u2028 c", "😀", ""]
    ids = packing.WordIds(tokenizer_path()).of([t.encode() for t in some])
    want = Tokenizer.from_file(tokenizer_path()).encode_batch(some, add_special_tokens=False)
    assert [i.tolist() for i in ids] == [e.ids for e in want]


# 5 secrets

SECRET = "password=hunter22secret"
ENCODED = [
    base64.b64encode(SECRET.encode()).decode(),
    base64.b64encode(base64.b64encode(SECRET.encode())).decode(),
    base64.b64encode(gzip.compress(SECRET.encode())).decode(),
    base64.b64encode(gzip.compress(zlib.compress(SECRET.encode()))).decode(),
    "".join(f"%{c:02X}" for c in SECRET.encode()),
    "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "password%253Dhunter22secret",
    base64.urlsafe_b64encode("".join(f"%5Cu{ord(c):04x}" for c in SECRET).encode()).decode(),
]


@pytest.mark.parametrize("hidden", ENCODED)
def test_layers_are_unwrapped(hidden):
    plain, spans, whole = secrets.scan(f"é before {hidden} after")
    assert plain == [] and whole
    assert any(k == "assign" and a == 9 and 9 + len(hidden) - 2 <= b <= 9 + len(hidden) for k, a, b in spans)


@pytest.mark.parametrize("before", ["id-", "/d/", "key-", "x_", "a", "ab", "abc", "a/b-"])
@pytest.mark.parametrize("after", ["", "a", "-b", "/ab", "_abc"])
def test_layers_that_touch_others(before, after):
    for hidden in (ENCODED[0].rstrip("="), ENCODED[2].rstrip("=")):
        spans = secrets.scan(f"é {before}{hidden}{after} z")[1]
        assert any(k == "assign" and b >= 2 + len(before) + len(hidden) - 2 for k, a, b in spans)


def test_layers_with_control_bytes():
    hidden = base64.b64encode(b"\0\1 " + SECRET.encode() + b"\xff\0").decode()
    assert [k for k, _, _ in secrets.scan(hidden)[1]] == ["assign"]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_every_member_and_block_is_scanned(pack):
    members = pack(b"first") + pack(SECRET.encode())
    assert {k for k, _, _ in secrets.scan(base64.b64encode(members).decode())[1]} == {"assign"}
    large = pack(bytes(5000) + SECRET.encode() + bytes(5000))
    for most in (100, 1000, 5010):
        plain, spans, whole = secrets.scan(base64.b64encode(large).decode(), most=most)
        assert {k for k, _, _ in spans} == {"assign"} and not whole


LONG = {
    "base64": base64.b64encode(np.random.default_rng(1).bytes(750_000)).decode(),
    "path": "/".join("ab cdefg hij klmnopqr".split() * 45_000),
    "letters": "a" * 1_000_000,
    "percent": "password%" + "25" * 50_000 + "3Dhunter22secret",
    "entity": "password&" + "#38;" * 250_000 + "#61;hunter22secret",
    "backslash": "password\\" + "x5cu005c" * 50_000 + "x3dhunter22secret",
}


@pytest.mark.parametrize("kind", LONG)
def test_long_texts_take_linear_time(kind):
    text = LONG[kind]
    began = time.process_time()
    spans = secrets.scan(text)[1]
    assert time.process_time() - began < 10
    assert (("assign", 0, len(text)) in spans) == (kind in ("percent", "entity", "backslash"))


def test_long_chains_are_those_of_short_ones():
    for levels in range(1, 40):
        text = "password%" + "25" * levels + "3Dhunter22secret"
        assert ("assign", 0, len(text)) in secrets.scan(text)[1]


@needs_tables
def test_secrets_of_whole_table_keep_the_plain_ones(spark, texts):
    """The prefilter and the order of the plain spans against the contract's patterns alone."""
    kinds = {
        "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        "access": re.compile(r"AKIA[A-Z0-9]+"),
        "hex": re.compile(r"[0-9a-f]+"),
    }
    least = {"assign": 6, "access": 20, "hex": 24}
    for r in QUERIES["op5_secret_scans"](spark, SF).collect():
        plain = []
        for at, (kind, pattern) in enumerate(kinds.items()):
            for m in pattern.finditer(texts[r["doc_id"]]):
                if len(m[2] if kind == "assign" else m[0]) >= least[kind]:
                    plain.append((m.start(), at, kind, m.end()))
        spans = [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(plain)]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r["spans"].split(","))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(p[2] == k for p in plain) for k in kinds]


def test_plain_matches():
    text = "API_KEY: 'abc123' token=abc secret=token: abcdefgh AKIA" + "A" * 16 + " " + "0f" * 12 + " ſecret=abcdefgh"
    assert secrets.as_text(secrets.matches(text)) == "assign:0:16,access:51:71,hex:72:96"
    assert secrets.matches("AKIA" + "A" * 15 + " " + "a" * 23) == []


def test_secret_odd_rows(spark, odd, none):
    assert secrets.find_secrets(odd).where("n_assign = 0 and spans = '' and complete").count() == len(ODD)
    assert secrets.find_secrets(none).collect() == [] and secrets.redact(none).columns == none.columns
    bomb = base64.b64encode(gzip.compress(bytes(5000))).decode()
    assert secrets.scan(bomb, most=1000)[2] is False
    one = spark.createDataFrame([(1, f"a {SECRET} b", 99), (2, None, None)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in secrets.redact(one).orderBy("doc_id").collect()] == [(1, "a [SECRET] b", 12), (2, None, None)]


# 6 SimHash


def slow_fingerprint(text):
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, errors):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= errors):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


@needs_tables
def test_simhash(spark, texts):
    found = by_id(QUERIES["op6_simhash_groups"](spark, SF))
    for i in sorted(texts)[:150]:
        assert found[i]["fingerprint"] == f"{slow_fingerprint(texts[i]):016x}"
    ids = sorted(found)
    fps = np.array([int(found[i]["fingerprint"], 16) for i in ids], dtype=np.uint64)
    assert [found[i]["component_id"] for i in ids] == [ids[c] for c in classes(fps, 4)]


@pytest.mark.parametrize("errors", [1, 4])
def test_trie_join(errors):
    rng = np.random.default_rng(errors)
    for _ in range(8):
        fps = set()
        for base in rng.integers(0, 2**63, 12).tolist():
            for _ in range(30):
                x = base
                for k in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                    x ^= 1 << k
                fps.add(x)
        fps = np.array(sorted(fps), dtype=np.uint64)
        assert simhash.trie_components(np.zeros(len(fps), dtype=np.int64), fps, errors).tolist() == classes(fps, errors)


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_keys_lose_no_link(spark, blocks):
    rng = np.random.default_rng(blocks)
    base = int(rng.integers(0, 2**62))
    fps = sorted({base ^ sum(1 << int(b) for b in set(rng.integers(0, 64, 4).tolist())) for _ in range(60)} | {base})
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in fps], "fp long")
    found = simhash.components(simhash.near_edges(df, 4, blocks)).collect()
    assert len({r["root"] for r in found}) == 1 and len(found) == len(fps) - 1


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert sorted(map(tuple, simhash.components(edges).collect())) == [(i, 0) for i in range(1, 61)] + [(101, 100)]


def test_simhash_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    empty = [r for r in rows if r["doc_id"] in (1, 2)]
    assert {r["fingerprint"] for r in empty} == {"0" * 16} and {r["component_id"] for r in empty} == {1}
    assert simhash.near_duplicates(none).collect() == []
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 3, 7, 8, None]
    assert simhash.keep_first(odd.where("doc_id in (1, 2, 7)")).count() == 2


# 7 languages


@needs_tables
def test_languages(spark, docs):
    found = QUERIES["op7_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.97


def test_language_odd_rows(odd, none):
    model = langid.train(odd, F.lit(True))
    rows = langid.identify(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2)} == {"und"}
    assert langid.train(none, F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.identify(none, model).collect() == []


def test_every_language_is_a_class(spark):
    rng = np.random.default_rng(11)
    rows = []
    for k in range(600):
        syllables = [bytes(rng.integers(97, 123, 3, dtype=np.uint8)).decode() for _ in range(6)]
        for n in range(3):
            rows.append((3 * k + n, " ".join(rng.choice(syllables, 40)), f"l{k}"))
    rows += [(9000 + n, "1 " * 20_000 + "only long texts here \u00e9 " * 900, "long") for n in range(2)] + [(9990, "1 2 \u00bd", "numbers")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df, F.lit(True))
    assert set(model.languages) == {f"l{k}" for k in range(600)} | {"long"}
    found = langid.identify(df, model).join(df.withColumnRenamed("doc_id", "i"), F.col("doc_id") == F.col("i")).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found if r["lang"] != "numbers"]) > 0.95


def test_numerals_are_no_letters():
    model = langid.fit(["the cat", "le chat"], ["en", "fr"])
    names, scores = model.predict(["\u00bd \u00b2 12 _", "\u00bd a", "\u2167", ""])
    assert names[0] == names[3] == langid.UNDETERMINED and names[1] != langid.UNDETERMINED and scores[0] == 0


def test_kernel_and_ridge_are_those_of_a_slow_solver():
    """All texts as landmarks: the values are those of ridge regression in the span of the kernel's columns."""
    rng = np.random.default_rng(12)
    texts = sorted({" ".join(rng.choice(list(letters), 9)) for letters in ("abcd", "efgh") * 15}, key=langid._digest)
    langs = ["x" if set(t) <= set("abcd ") else "y" for t in texts]
    model = langid.fit(texts, langs)
    grams = [set(np.concatenate(langid.grams_of(t.encode())).tolist()) for t in texts]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in grams] for a in grams])
    weight = np.array([1 / langs.count(l) for l in langs])
    weight /= weight.mean()
    y = np.array([[1.0 if l == name else -1.0 for name in ("x", "y")] for l in langs])
    # Minimise the weighted squares plus the ridge over functions sum_j a_j k(., x_j).
    a = np.linalg.solve(kernel @ (weight[:, None] * kernel) + 1e-3 * len(texts) * kernel + 1e-12 * np.eye(len(texts)), kernel @ (weight[:, None] * y))
    assert model.values([t.encode() for t in texts]) == pytest.approx(kernel @ a, abs=1e-2)


# 8 toxicity


@needs_tables
def test_toxicity(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op8_toxicity"](spark, SF).join(labels, "doc_id").collect()
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(clean) < 0.03 and np.mean([r["predicted"] for r in rows if r["toxic"] == 1]) > 0.85
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_subsequence_kernel():
    def slow(word):
        padded, values, square = [0, *word, 0], collections.Counter(), 0.0
        for i in range(len(padded)):
            for k in range(i + 2, min(i + 5, len(padded))):
                for j in range(i + 1, k):
                    if all(padded[i + 1 : k]):
                        weight = toxicity.DECAY ** (k - i - 2)
                        values[padded[i] << 12 | padded[j] << 6 | padded[k]] += weight
                        square += weight**2
        return {c: v / square**0.5 for c, v in values.items()}

    words = [b"\x01\x02\x03\x04", b"\x05", b"\x01\x02\x18\x03\x04"]
    found = toxicity.features(words)
    assert all(f == pytest.approx(slow(w)) for f, w in zip(found, words, strict=True))
    weights = np.zeros(1 << 18, dtype=np.float32)
    for c, v in found[0].items():
        weights[c] = v
    symbols = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", dtype=np.uint8)
    assert toxicity.word_scores(symbols, weights) == pytest.approx(toxicity.kernel(found, found[:1])[:, 0], abs=1e-5)
    assert toxicity.word_scores(symbols, weights)[2] > 0.3


def test_gapped_and_disguised_words_meet():
    assert toxicity.words_of("i.d.i.o.t") == toxicity.words_of("I D I O T") == toxicity.words_of("1d10t")


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(3, 1), (7, 0), (8, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels, F.lit(True))
    rows = toxicity.score_texts(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.train(none, labels, F.lit(True)) is None
    assert toxicity.score_texts(odd, None).where("score <> 0").isEmpty()
    assert toxicity.keep_clean(odd, None).count() == len(ODD) and toxicity.keep_clean(none, model).columns == odd.columns


# 9 nearest vectors


@needs_tables
def test_nearest(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    unit = np.array([r["embedding"] for r in rows], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    found = collections.defaultdict(dict)
    for r in QUERIES["op9_nearest_vectors"](spark, SF).collect():
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        cosine = unit @ unit[i]
        best = sorted((-c, v) for c, v in zip(cosine, ids, strict=True) if v != ids[i])[:5]
        mine = [found[ids[i]][k] for k in range(1, 6)]
        assert mine == sorted(mine, key=lambda x: (-x[1], x[0]))
        hits += len({v for v, _ in mine} & {v for _, v in best})
        total += 5
    assert hits / total >= 0.9


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [2.0, 0.0]), (4, [2.0, 0.0]), (50, [0.0, 1.0]), (6, None), (7, [0.0, 0.0]), (8, [nan, 1.0])]
    rows += [(9, [None, 1.0]), (10, [inf, 1.0]), (11, []), (12, [1.0]), (100, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({n: F.lit(1) for n in ("row", "list", "rank")})
    found = sorted(map(tuple, ann.nearest(df, F.col("vec_id") % 50 == 0).collect()))
    assert found == [(0, 1, 4, 1.0), (0, 2, 5, 1.0), (0, 3, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 4, 0.0), (50, 3, 5, 0.0)]
    assert ann.nearest(df.limit(0), F.lit(True)).collect() == []


def test_many_equal_vectors_stay_whole(spark):
    df = spark.range(9000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    found = ann.nearest(df, F.col("vec_id") == 8950).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [0, 1, 2, 3, 4]


def test_small_groups_find_others(spark):
    """Groups of 3 near-equal vectors, some of which are all of a list, among many copies."""
    rng = np.random.default_rng(9)
    copies = np.repeat(rng.normal(size=(12, 8)), 340, axis=0)
    groups = np.repeat(rng.normal(size=(8, 8)), 3, axis=0) + 1e-4 * rng.normal(size=(24, 8))
    points = np.concatenate([copies, groups])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") >= len(copies)).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["score"])
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    for i in range(len(copies), len(points)):
        cosine = unit @ unit[i]
        cosine[i] = -2
        assert found[i] == pytest.approx(np.sort(cosine)[:-6:-1])


def test_reach_goes_past_small_lists():
    far = np.array([[1e-6, 0.5, 0.6, 0.7, 2.0]])
    assert ann.reach(far, np.array([3, 0, 2, 300, 300]), 6, 1, 1.0).tolist() == [0.7]
    assert ann.reach(far, np.array([3, 1, 0, 0, 0]), 6, 1, 1.0).tolist() == [0.5]
    assert ann.reach(far, np.array([600, 0, 0, 0, 0]), 6, 3, 1.3).tolist() == [0.6]


# 10 mixing


@needs_tables
def test_mixing(spark, texts):
    rows = QUERIES["op10_source_mix"](spark, SF).collect()
    assert len(rows) == len(texts)
    sources = {}
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].encode().split()) and r["taken"] in (0, r["size"], 2 * r["size"])
        sources.setdefault(r["source"], []).append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in sources.items()}
    weights = dict(zip(sorted(sizes), [5, 2, 1] * len(sizes), strict=False))
    targets, budget, open_ = dict.fromkeys(sizes, 0.0), 1.5 * sum(sizes.values()), set(sizes)
    while budget > 1e-6 and open_:
        total, given = sum(weights[s] for s in open_), budget
        budget = 0.0
        for s in sorted(open_):
            targets[s] += given * weights[s] / total
            if targets[s] >= 2 * sizes[s]:
                budget += targets[s] - 2 * sizes[s]
                targets[s] = 2 * sizes[s]
                open_.discard(s)
    for s, rs in sources.items():
        assert rs[0]["source_size"] == sizes[s] and rs[0]["target"] == pytest.approx(targets[s])
        assert abs(sum(r["taken"] for r in rs) - targets[s]) < 1
    assert sorted(map(tuple, QUERIES["op10_source_mix"](spark, SF).collect())) == sorted(map(tuple, rows))


def test_budgets_are_filled_exactly():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        lengths = rng.choice(np.arange(1, 300), 6, replace=False).astype(np.int64)
        counts = rng.integers(1, 4, 6).astype(np.int64)
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        taken = mixing.fill_budget(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all() and (lengths * taken).sum() <= budget
    taken = mixing.fill_budget(np.array([7, 1000]), np.array([10**6, 10**6]), 123_456_789)
    assert (np.array([7, 1000]) * taken).sum() == 123_456_789


def test_mix_odd_rows(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.mix(none).collect() == []
    assert mixing.repeat(odd, mixing.mix(odd)).columns == odd.columns


# 11 repeated substrings


def struck(texts, length):
    """Kept bytes and spans by brute force, by row."""
    windows = collections.Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for p in range(len(t) - length + 1):
            if windows[t[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(c for c, g in zip(t, gone, strict=False) if not g)
        found.append((len(t), int(gone.sum()), int((gone[:-1] < gone[1:]).sum()) + int(gone[0]), hashlib.sha256(kept).hexdigest(), kept))
    return found


def test_ranks_and_common_prefixes_are_those_of_sorted_suffixes():
    rng = np.random.default_rng(5)
    for trial in range(60):
        texts = [bytes(rng.choice([97, 98, 0], rng.integers(0, 14))) for _ in range(rng.integers(1, 7))]
        most = [200, 3][trial % 2]
        common, ranks = substrings.column_wise(texts, most)
        suffixes = sorted((list(t[k:]) + [1000 + i], i, len(t) - k) for i, t in enumerate(texts) for k in range(len(t) + 1))
        where = {(i, size): n for n, (_, i, size) in enumerate(suffixes)}
        for i, t in enumerate(texts):
            assert ranks[i].tolist() == [where[i, size] for size in range(len(t) + 1)]
        for n in range(1, len(suffixes)):
            shared = os.path.commonprefix([suffixes[n - 1][0], suffixes[n][0]])
            assert common[n] == min(len(shared), most)


def passages(seed=6):
    rng = np.random.default_rng(seed)
    word = lambda: bytes(rng.integers(97, 123, rng.integers(2, 9), dtype=np.uint8)).decode()
    some = [" ".join(word() for _ in range(12)) for _ in range(5)]
    texts = []
    for n in range(150):
        parts = [" ".join(word() for _ in range(rng.integers(0, 20))) for _ in range(4)]
        parts[rng.integers(0, 4)] += some[rng.integers(0, 5)][rng.integers(0, 30) :] if n % 3 else some[0]
        texts.append("é ".join(parts))
    return [*texts, texts[0], texts[0], "ab" * 300, "x" * 700, "", None, "\0" * 90 + "\ufffd" * 40]


@pytest.mark.parametrize(("length", "kinds"), [(40, 256), (40, 2), (17, 256), (200, 256)])
def test_repeats_are_struck(spark, monkeypatch, length, kinds):
    monkeypatch.setattr(substrings, "KINDS_AT_ONCE", kinds)
    monkeypatch.setattr(substrings, "FRAGMENTS_AT_ONCE", 20)
    rows = list(enumerate(passages()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("c") for n in ("key", "body", "wanted", "anchor")})
    found = {r["doc_id"]: tuple(r)[1:] for r in substrings.remove_repeats(df, length).collect()}
    wanted = struck([(t or "").encode() for _, t in rows], length)
    assert found == {i: (n, gone, spans, digest, bytearray(kept)) for i, (n, gone, spans, digest, kept) in enumerate(wanted)}


def test_repeats_of_long_texts_and_segments(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 1 << 10)
    rng = np.random.default_rng(7)
    body = bytes(rng.integers(97, 123, 6000, dtype=np.uint8)).decode()
    texts = [body, "x" + body[1500:4200], "word " * 9000, "a" * 50_000]
    anchors = substrings.Anchors(50)
    for text in texts:
        starts = [x for _, _, first, last, _ in anchors.of(text.encode()) for a, b in zip(first, last, strict=True) for x in range(a, b + 1)]
        assert starts == list(range(len(text) - 49))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: tuple(r)[1:5] for r in substrings.remove_repeats(df, 50).collect()}
    gone = {0: (6000, 2700, 1), 1: (2701, 2700, 1), 2: (45_000, 45_000, 1), 3: (50_000, 50_000, 1)}
    assert {i: f[:3] for i, f in found.items()} == gone


@needs_tables
def test_repeats_of_whole_table(spark, texts):
    found = by_id(QUERIES["op11_repeated_substrings"](spark, SF))
    body = {i: (t or "").encode() for i, t in texts.items()}
    digests = {i: [xxhash.xxh3_128_digest(t[p : p + 200]) for p in range(len(t) - 199)] for i, t in body.items()}
    often = collections.Counter(d for each in digests.values() for d in each)
    for i, t in body.items():
        edges = np.zeros(len(t) + 1, dtype=int)
        for p, d in enumerate(digests[i]):
            if often[d] > 1:
                edges[p] += 1
                edges[p + 200] -= 1
        gone = np.cumsum(edges)[:-1] > 0
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        spans = int(np.sum(np.diff(np.r_[0, gone.astype(int)]) == 1))
        assert tuple(found[i]) == (i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_repeat_odd_rows(odd, none):
    rows = substrings.remove_repeats(odd, 20).collect()
    assert len(rows) == len(ODD)
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"]) for r in rows if r["doc_id"] == 3] == [(42, 42, 1)] * 2
    assert all(r["n_bytes"] == 0 and r["kept_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows if r["doc_id"] in (1, 2))
    assert substrings.remove_repeats(none).collect() == []


# 12 filter interactions


def slow_audit(rows, labels):
    """`(part, order, step): counts` from every row and order by definition."""
    import itertools
    import re as plain

    fails = []
    for i, text, part in rows:
        text = text or ""
        words = plain.findall(r"[^\x20\x09-\x0d]+", text)
        copy = i is not None and any(j is not None and j < i and (other or "") == text for j, other, _ in rows)
        failed = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(plain.findall("[A-Z]", text)) > 10 * len(text), "D": bool(plain.search("[#$%&*|]", text)), "E": copy,
        }
        fails.append((part or "", {f for f, x in failed.items() if x}, [any(q[k] == 1 for q in labels if q[0] == i and i is not None) for k in (1, 2)]))
    found = {}
    for part in {p for p, _, _ in fails}:
        share = collections.Counter()
        mine = [f for f in fails if f[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                gone = [x for x in mine if f in x[1] and not x[1] & set(order[: step - 1])]
                share[f] += len(gone)
                found[part, order, step] = [
                    sum(not x[1] & set(order[:step]) for x in mine), len(gone), sum(f in x[1] and bool(x[1] & set(order[: step - 1])) for x in mine),
                    sum(x[1] == {f} for x in mine), sum(x[2][0] for x in gone), sum(x[2][1] for x in gone), f,
                ]
        for (p, _, _), x in found.items():
            if p == part:
                x[6] = share[x[6]]
    return {k: tuple(v) for k, v in found.items()}


def test_audit(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n in range(120):
        words = [f"w{x}" for x in rng.integers(0, 400, rng.integers(60, 180))]
        words += ["LOUD"] * int(rng.integers(0, 2) * 60) + ["50%"] * int(rng.integers(0, 2)) + ["again"] * int(rng.integers(0, 2) * 90)
        rows.append((n, " ".join(words), [None, "en", "de"][n % 3]))
    rows += [(200, rows[0][1], "en"), (200, rows[0][1], "en"), (-1, rows[3][1], "de"), (None, rows[0][1], "en"), (7, None, "en"), (8, "", None)]
    rows += [(9, "\x1cone\u00a0word\x0b" * 200, "fr")]
    labels = [(n, int(n % 4 == 0), int(n % 7 == 0)) for n in range(0, 210, 2)] + [(4, 0, 0), (None, 1, 1), (6, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({n: F.lit("c") for n in ("id", "part", "mask", "words", "n")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("c"))
    found = {tuple(r)[:3]: tuple(r)[3:] for r in audit.audit_documents(docs, marks).collect()}
    assert found == slow_audit(rows, labels)


def test_removal_steps_are_the_first_failed_filter():
    orders, steps = audit.removal_steps(3)
    for p, order in enumerate(orders):
        for mask in range(8):
            wanted = min([s for s, f in enumerate(order, 1) if mask >> f & 1], default=np.inf)
            assert steps[mask, p] == wanted


def test_audit_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    first = audit.audit_documents(odd, labels).where("filter_order = 'ABCDE' and step = 1")
    assert {r["part"]: r["kept"] + r["removed"] for r in first.collect()} == {"": 2, "en": 4, "de": 1}
    assert audit.audit_documents(none, labels).collect() == []


# 13 spelling variants


def slow_variants(n):
    """`word: (form, root, n, n_near, form_n)` by comparing all words."""

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    close = {w: [x for x in n if x != w and near(w, x)] for w in n}
    form = {w: min(c, key=lambda x: (-n[x], x)) for w, c in close.items() if c}
    form = {w: f for w, f in form.items() if n[f] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(close[w]), n[form[w]] if w in form else None) for w in n}


def runs_of(rows):
    counts = collections.Counter()
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in rows:
        for w in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            w = w.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}


def vocabulary_of(seed, size):
    rng = np.random.default_rng(seed)
    letters = list("abé")
    words = {"".join(rng.choice(letters, rng.integers(6, 9))) for _ in range(size)}
    return {w: int(5 ** rng.integers(0, 6) + rng.integers(0, 5)) for w in words}


@pytest.mark.parametrize(("frequent", "long_list"), [(64, 128), (3, 128), (64, 2), (3, 2), (10**6, 1)])
def test_variants_of_dense_vocabulary(spark, frequent, long_list):
    n = vocabulary_of(frequent + long_list, 400)
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    found = variants.group_variants(stage(words, "words"), frequent=frequent, long_list=long_list)
    assert {r["word"]: tuple(r)[1:] for r in found.collect()} == slow_variants(n)


def test_affected_grams_bound_every_edit():
    rng = np.random.default_rng(9)
    frequent = {"aba": 9, "abab": 9, "bab": 9, "^ab": 9, "ba$": 9, "baba": 9}
    for _ in range(200):
        word = "".join(rng.choice(list("ab"), rng.integers(6, 10)))
        at = int(rng.integers(0, len(word) + 1))
        for other in (word[:at] + "b" + word[at:], word[:at] + "a" + word[at + 1 :], word[:at] + word[at + 1 :]):
            if other == word or len(other) < 6:
                continue
            mine, theirs = (variants.decompose(f"^{w}$", frequent) for w in (word, other))
            shared = collections.Counter(g for g, _ in mine) & collections.Counter(g for g, _ in theirs)
            assert sum(shared.values()) >= len(mine) - variants.affected(mine, len(word) + 2)
            assert {g for g, _ in variants.rare_grams(word, frequent)} & {g for g, _ in variants.rare_grams(other, frequent)}


def test_dictionary_is_bounded(spark):
    words = spark.createDataFrame([(w,) for w in vocabulary_of(1, 300)], "word string")
    assert 0 < len(variants.frequent_grams(words, frequent=0, dictionary=50)) <= 50


@needs_tables
def test_variants_of_whole_table(spark, texts):
    found = {r["word"]: tuple(r)[1:] for r in QUERIES["op13_spelling_variants"](spark, SF).collect()}
    n = runs_of(texts.items())
    assert found.keys() == n.keys()
    by_rest = collections.defaultdict(set)
    for w in n:
        for k in range(len(w)):
            by_rest[k, w[:k] + w[k + 1 :]].add(w)
            by_rest[-1, w[:k] + w[k + 1 :]].add(w)
    close = collections.defaultdict(set)
    for (k, rest), group in by_rest.items():
        for w in group:
            close[w] |= (group - {w}) if k >= 0 else ({rest} & n.keys())
            if k < 0 and rest in n:
                close[rest].add(w)
    for w, (form, root, count, n_near, form_n) in found.items():
        assert (count, n_near) == (n[w], len(close[w]))
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        wanted = best if best is not None and n[best] >= 5 * n[w] else None
        assert (form, form_n) == (wanted, n[wanted] if wanted else None)
        assert root == (w if form is None else found[form][1])


def test_variant_odd_rows(spark, odd, none):
    assert variants.spelling_variants(odd).collect() == []
    assert variants.spelling_variants(none).collect() == []
    rows = [(i, "\u00c9COLE\u00d7s \u00e9colees, spelling's speling") for i in (None, None, 1, 2, 3, 3)] + [(9, "longword " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("c") for c in ("word", "n", "key", "id", "run")})
    found = {r["word"]: tuple(r)[1:] for r in variants.spelling_variants(df).collect()}
    assert found == slow_variants(runs_of(rows)) and "\u00c9cole\u00d7s" in found
    with pytest.raises(ValueError):
        variants.near_pairs(spark.createDataFrame([("abcd", 5)], "word string, n long"))
