"""The ten operators and the pipeline against brute force, exact round trips or held-out labels, and their edge cases."""

import base64
import hashlib
import io
import itertools
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from corvid.llm import byte_bpe, chat, exact_dedup, mixing, mpeg_audio, quality, secrets, simhash, token_files, toxicity, wavelet

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, sha string, print long, bucket long, `_sha` string, `_key` long"
ODD = [None, "", " ", "\t\n", "a", "one two three", "x" * 5000, "wörd ß é 字 😀 " * 40, "a b c d e f g", "a  b  c\x85 \n d", "tie tie", "tie tie", "<|endoftext|> </turn>"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, columns whose names clash with inner ones."""
    rows = [(k, t, None, f"s{k % 2}", None, 1, "c", 2, 3, "d", 4) for k, t in enumerate(ODD)]
    rows += [(None, "a b c d e f g", "en", None, 1, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame([*rows, rows[5], rows[5], rows[8]], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, k % 2) for k in range(13)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(sf):
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# 1


def brute_base(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:o|O)(?:r|R)(?:d|D)|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans)]


def test_secrets(spark, sf, docs):
    got = by_id(secrets.op1_secret_scan(spark, sf))
    assert len(got) == len(docs)
    for i, text in docs:
        want = brute_base(text)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert set(want) <= set(got[i]["spans"].split(","))
    assert any(r["n_hex"] for r in got.values())


def brute_secrets(rows, owners=3, repos=6, least=3.0):
    """id: (spans, verdicts) by a plain pass over every text and a count over every pair of value and document."""
    found = {}
    for i, text, lang, source in rows:
        base = [(m.start(), 0, m.end(), m[2]) for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("(?i:", "((?i:", 1).replace("key)", "key))", 1), text or "") if len(m[2]) >= 8]
        base += [(m.start(), 1, m.end(), m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
        base += [(m.start(), 2, m.end(), m[0]) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 32]
        other = [(m.start(), 3, m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or "") if not any(s < m.end() and m.start() < e for s, _, e, _ in base)]
        other = [x for x in other if re.search("[0-9]", x[3]) and re.search("[A-Za-z]", x[3]) and secrets.entropy(x[3]) >= least]
        found[i] = (sorted(base + other), lang, source)
    held = {}
    for spans, lang, source in found.values():
        for *_, value in spans:
            held.setdefault(value, set()).add((source, (source, lang)))
    out = {}
    for i, (spans, _, _) in found.items():
        told = []
        for s, k, e, value in spans:
            copied = len({o for o, _ in held[value]}) >= owners or len({r for _, r in held[value]}) >= repos
            verdict = "example" if copied else "live" if secrets.looks_live(value, least) else "dull"
            if k < 3 or verdict == "live":
                told.append((f"{secrets.KINDS[k]}:{s}:{e}", verdict))
        out[i] = told
    return out


def test_secrets_ownership(spark):
    """Spans and verdicts on a corpus with copied tokens (by owners, and by repositories of few owners) and single-owner ones."""
    order = np.random.default_rng(11)
    letters = [*"ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789"]
    token = lambda n: "".join(order.choice(letters, n))
    by_owners, by_repos, live, dull = token(24), token(30), [token(22) for _ in range(8)], "abcdefgh12345678abcdefgh"
    rows = [(k, f"é see {by_owners} there", "en", f"s{k % 4}") for k in range(8)] + [(10 + k, f"{by_repos} x token={by_repos}", f"l{k}", f"t{k % 2}") for k in range(7)]
    rows += [(30 + k, f"w {v} secret: {v} AKIA{'Q7W2E9R4T6Y1'} {dull}", "en" if k % 3 else None, f"s{k}") for k, v in enumerate(live)]
    rows += [(50, "password = changeme-example api_key='abcdefghijklmnop'", "en", None), (51, "password=Zx9Kq2Lm", None, None), (52, None, None, None), (53, "", "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: [(f"{x['kind']}:{x['start']}:{x['end']}", x["verdict"]) for x in r["spans"]] for r in secrets.scan_secrets(df).collect()}
    want = brute_secrets(rows)
    assert got == want
    seen = {v for spans in want.values() for _, v in spans}
    assert seen == {"example", "live", "dull"} and any(k.startswith("owner") for spans in want.values() for k, _ in spans)
    # the aggregation decides: repositories alone make the second token an example, and without that bound it is live
    assert {v for _, v in got[10]} == {"example"}
    loose = {r["doc_id"]: {x["verdict"] for x in r["spans"]} for r in secrets.scan_secrets(df, example_repos=100).collect()}
    assert loose[10] == {"live"}


def test_secrets_odd(spark, odd):
    assert secrets.scan_secrets(odd).count() == odd.count()
    assert secrets.scan_secrets(odd.limit(0)).count() == 0


# 2


def test_exact_dedup(spark, odd):
    rows = exact_dedup.copies(odd).collect()
    assert len(rows) == odd.count()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for r in odd.collect():
        groups.setdefault(hashlib.sha256(norm(r["text"]).encode()).digest(), []).append(r["doc_id"])
    for sha, some in itertools.groupby(sorted(rows, key=lambda r: bytes(r["sha"])), key=lambda r: bytes(r["sha"])):
        some = list(some)
        least = min((i for i in groups[sha] if i is not None), default=None)
        assert all(r["keep_id"] == least and r["group_size"] == len(groups[sha]) for r in some)
        assert sum(r["kept"] for r in some) == 1
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert exact_dedup.drop_copies(odd.limit(0)).count() == 0


@pytest.mark.parametrize("max_bits", [1 << 15, 1 << 18, 1 << 28])
def test_exact_dedup_ranges(spark, max_bits):
    """Past one filter's size hash ranges have filters of their own: the same rows stay, and few that occur once are suspected."""
    docs = spark.range(60_000).selectExpr("id as doc_id", "concat('t', id % 50000) as text", "id as range", "'x' as own", "id as row")
    ranges, bits = exact_dedup.filter_bits(60_000, max_bits)
    assert bits <= max_bits and ranges * bits >= 16 * 60_000 and (ranges > 1) == (max_bits < 1 << 20)
    if ranges > 9:
        docs, n = docs.where("doc_id < 6000 or doc_id >= 50000 and doc_id < 53000"), 6000
        assert exact_dedup.filter_bits(9000, max_bits)[0] == 5
    else:
        n = 50_000
    report = exact_dedup.copies(docs, max_bits=max_bits).cache()
    twice = 2 * (docs.count() - n)
    assert report.where("kept").count() == n and report.where("group_size = 2").count() == twice
    assert report.where("suspected and group_size = 1").count() < n / 20
    kept = exact_dedup.drop_copies(docs, max_bits=max_bits)
    assert kept.columns == docs.columns and kept.count() == n and kept.where("doc_id >= 50000").count() == 0


def test_exact_dedup_hot(spark):
    """A third of all rows is one text, and one id repeats: one row stays."""
    docs = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "if(id % 3 = 0, 'hot  text', concat('t', id)) as text")
    kept = exact_dedup.drop_copies(docs)
    assert kept.count() == 20_001 and kept.where("text = 'hot  text'").count() == 1


# 3


def brute_print(text, size=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """id: least id reachable, ids None last."""
    ids = list(range(len(prints)))
    root = list(ids)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(x) for x in ids]


def test_simhash(spark, sf, docs):
    got = by_id(simhash.op3_simhash(spark, sf))
    prints = [brute_print(t) for _, t in docs]
    assert all(int(got[i]["fingerprint"], 16) == p for (i, _), p in zip(docs, prints, strict=True))
    assert [got[i]["component_id"] for i, _ in docs] == [docs[c][0] for c in brute_classes(prints)]


@pytest.mark.parametrize("limit, hot_rows", [(8, 1 << 20), (4096, 1 << 20), (8, 20), (4096, 60)])
def test_covering_finds_every_link(spark, limit, hot_rows):
    """Chains, dense clusters and over-full buckets: components equal brute force."""
    order = np.random.default_rng(limit)
    prints = {0, simhash.FULL}
    for _ in range(12):
        p = int(order.integers(0, 1 << 63)) << 1
        for _ in range(30):
            q = p
            for b in order.choice(64, int(order.integers(0, 7)), replace=False):
                q ^= 1 << int(b)
            prints.add(q)
            p = q if order.random() < 0.3 else p
    prints = sorted(prints, key=simhash._signed)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, limit, hot_rows)).collect()}
    want = brute_classes(prints)
    assert [roots.get(simhash._signed(p), simhash._signed(p)) for p in prints] == [simhash._signed(prints[w]) for w in want]


def test_covering_family():
    masks = simhash.submasks(simhash.FULL)
    order = np.random.default_rng(0)
    for _ in range(2000):
        diff = sum(1 << int(b) for b in order.choice(64, 4, replace=False))
        assert any(not diff & m for m in masks)


def test_simhash_odd(spark, odd):
    got = simhash.near_classes(odd)
    assert got.count() == odd.count()
    empty = [r for r in got.collect() if r["print"] == 0]
    assert {r["class_id"] for r in empty} == {0}
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == got.select("class_id").distinct().count()
    assert simhash.near_classes(odd.limit(0)).count() == 0


# 4


def test_token_files(spark, sf, docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = by_id(token_files.op4_token_files(spark, sf)), 0
    for (i, _), e in zip(docs, whole.encode_batch([t for _, t in docs], add_special_tokens=False), strict=True):
        ids = [*e.ids, 1]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_word_encoder():
    encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    order = np.random.default_rng(3)
    letters = [*"aAéÉßİΣςſK'strevmd 09²½_-–\x85\xa0 \t\n\r\x0b\x1cćeẞ字😀.,!ñ", "'s", "'re", " \n", "<|endoftext|>"]
    texts = ["".join(order.choice(letters, int(order.integers(0, 30)))) for _ in range(3000)]
    ids, sizes = encoder.encode(pa.array(texts))
    want = [e.ids for e in encoder.whole.encode_batch(texts, add_special_tokens=False)]
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_token_files_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["see <|endoftext|> here", "a<|startoftext|>b <|ENDOFTEXT|>", "<|endoftext|><|endoftext|>", "é<|endoftext|> <|endoftext| >", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = f"file://{tmp_path}/t"
    got = {r["id"]: r["crc32"] for r in token_files.read_token_files(token_files.write_token_files(docs, folder, path), folder).collect()}
    coded = [[*Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert coded[0] == [862, 49407, 763, 1]
    assert got == {i: zlib.crc32(np.array(ids, "<u4").tobytes()) for i, ids in enumerate(coded)}


def test_token_files_odd(spark, odd, tmp_path):
    for docs in (odd, odd.limit(0)):
        folder = f"file://{tmp_path}/{docs.count()}"
        manifest = token_files.write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), range_bytes=4000, shard_tokens=50)
        got = token_files.read_token_files(manifest, folder).collect()
        assert len(got) == docs.count()
        at = 0
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["n_tokens"]


@pytest.mark.parametrize("tokens", [[], [7], [3, 3, 3], list(range(40)), np.random.default_rng(1).integers(0, 9, 2000).tolist(), np.random.default_rng(2).integers(0, 70_000, 3000).tolist()])
def test_wavelet(tokens):
    tokens = np.array(tokens, np.uint32)
    image = wavelet.to_bytes(wavelet.WaveletMatrix.build(tokens), np.arange(2), np.array([1, max(len(tokens) - 1, 0)]))
    matrix, ids, lengths = wavelet.from_bytes(image)
    assert matrix.tokens().tolist() == tokens.tolist() and ids.tolist() == [0, 1] and len(lengths) == 2
    for i in range(0, len(tokens), 37):
        t = int(tokens[i])
        places = np.flatnonzero(tokens == t)
        assert matrix.access(i) == t and matrix.count(t) == len(places)
        assert matrix.rank(t, i) == (places < i).sum() and matrix.select(t, len(places) - 1) == places[-1]
        assert matrix.occurrences(t)[:50] == places.tolist()[:50]
    assert matrix.count(1 << 20) == 0
    with pytest.raises(IndexError):
        matrix.select(1 << 20, 0)


def test_wavelet_reads_parts():
    """Access and rank of an open file read its head and one block a plane."""
    tokens = np.random.default_rng(4).integers(0, 40_000, 600_000).astype(np.uint32)
    image = wavelet.to_bytes(wavelet.WaveletMatrix.build(tokens), np.arange(3), np.array([1, 2, 599_997]))

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            self.taken += len(out)
            return out

    file = Counted(image)
    matrix, ids, _ = wavelet.opened(file)
    head = file.taken
    assert len(ids) == 0 and head < len(image) / 5
    for i in (0, 65_535, 65_536, 599_999):
        before = file.taken
        assert matrix.access(i) == tokens[i] and file.taken - before < len(image) / 4
    t = int(tokens[300_000])
    places = np.flatnonzero(tokens == t)
    assert matrix.rank(t, 300_000) == (places < 300_000).sum() and matrix.occurrences(t) == places.tolist()


def test_token_files_access(spark, sf, tmp_path):
    """A shard's tokens one by one, and rows that repeat an id in several ranges."""
    folder, path = f"file://{tmp_path}/t", public_tokenizers.path("word_bpe_49k.json")
    docs = spark.range(300).selectExpr("if(id < 100, 5, id) as doc_id", "if(id < 50, 'same text here', concat('w', id, ' x y')) as text", "id as row", "'c' as ids")
    manifest = token_files.write_token_files(docs, folder, path, range_bytes=400, shard_tokens=100)
    shards = manifest.orderBy("part", "seq").collect()
    got = sorted(token_files.read_token_files(manifest, folder, 100).collect(), key=lambda r: r["start"])
    assert len(got) == 300 and [r["id"] for r in got] == sorted(r["id"] for r in got) and len({s["part"] for s in shards}) > 3
    first = shards[0]
    matrix, ids, sizes = wavelet.from_bytes(open(first["path"], "rb").read())
    whole = matrix.tokens().tolist()
    assert [token_files.token_at(folder, first["path"], k) for k in range(0, len(whole), 9)] == whole[::9] and whole[sizes[0] - 1] == 1


# 5


def test_mixing_weights():
    tokens = [1000, 100, 10]
    a = mixing.exponent_for_entropy(tokens, 0.9)
    assert 0 < a < 1 and mixing.entropy(mixing.weights(tokens, a)) >= 0.9 * np.log2(3) - 1e-6
    assert mixing.exponent_for_entropy([5, 5], 0.9) == 1.0 and mixing.exponent_for_entropy([], 0.9) == 1.0
    b = mixing.exponent_for_repeats(tokens, 2.0)
    epochs = [w / t for w, t in zip(mixing.weights(tokens, b), tokens, strict=True)]
    assert abs(max(epochs) / min(epochs) - 2) < 1e-6
    plan = mixing.plan({"a": 1000, "b": 100, None: 10, "z": 0}, b)
    assert plan["z"] == (0, 1, 0) and all(whole >= 1 for _, whole, _ in plan.values())


def test_mixing_realised(spark):
    rows = [(k, "w " * (1 + k % 5), "hot" if k % 3 else f"s{k % 7}") for k in range(3000)] + [(None, "a", None), (5000, None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixture = mixing.Mixture(docs, "source", "doc_id", "text", 1, 0.99, None, None, False, 100)
    got = mixture.realised(500).collect()
    drawn = {}
    for r in got:
        drawn[r["source"]] = drawn.get(r["source"], 0) + r["n_tokens"]
    for s, wanted in mixture.table.select("s", "wanted").collect():
        assert wanted - 5 <= drawn.get(s, 0) <= wanted or wanted == 0
    assert max(r["block"] for r in got) >= 10
    times = {}
    for r in got:
        times[r["id"]] = times.get(r["id"], 0) + 1
    again = {}
    for r in mixing.mix(docs, seed=1, entropy_share=0.99).collect():
        again[r["doc_id"]] = again.get(r["doc_id"], 0) + 1
    assert times == again


def test_mixing_odd(spark, odd):
    kept = mixing.mix(odd, repeat_limit=1.25, cover=True)
    assert kept.columns == odd.columns and kept.count() >= odd.count()
    assert kept.distinct().count() == odd.distinct().count()
    assert mixing.mix(odd.limit(0), repeat_limit=1.25, cover=True).count() == 0


@pytest.mark.parametrize("share, limit", [(0.9, None), (0.99, None), (None, 1.5)])
def test_mixing_many_sources(spark, share, limit):
    """Beyond ``max_sources`` the plan is a table: the same exponent, plan and rows."""
    rows = [(k, "w " * (1 + k % 5), None if k % 50 == 0 else "hot" if k % 3 else f"s{k % 70}") for k in range(2000)] + [(3000, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (mixing.Mixture(docs, "source", "doc_id", "text", 1, share, limit, None, limit is not None, n) for n in (100, 3))
    assert one.small and not two.small and abs(one.exponent - two.exponent) < 2e-9
    assert sorted(map(str, one.table.collect())) == sorted(map(str, two.table.select(one.table.columns).collect()))
    assert sorted(map(str, one.realised(500).collect())) == sorted(map(str, two.realised(500).collect()))
    drawn = [sorted(r["doc_id"] for r in mixing.mix(docs, seed=1, entropy_share=share, repeat_limit=limit, max_sources=n).collect()) for n in (100, 3)]
    assert drawn[0] == drawn[1]


# 6


@pytest.fixture(scope="session")
def bpe():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, sf, docs, bpe):
    got = by_id(byte_bpe.op6_byte_bpe(spark, sf))
    for i, text in docs:
        ids = bpe.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_byte_bpe_fuzz(bpe):
    coder = byte_bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    order = np.random.default_rng(5)
    letters = [*"aAéÉßİΣςſK'strevmd 09²½_-–\x85\xa0 \t\n\r\x0b\x1cćeẞ字😀.,!ñ\0", "'s", "'re", " \n", "  ", "<|endoftext|>"]
    texts = ["".join(order.choice(letters, int(order.integers(0, 40)))) for _ in range(3000)] + ["a" * 5000, "ab" * 3000 + " " * 2000, " " * 700, "=-" * 900, ""]
    ids, sizes = coder.encode(pa.array(texts))
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [bpe.encode_ordinary(t) for t in texts]
    assert coder.decode(ids, sizes) == [t.encode() for t in texts]
    with pytest.raises(KeyError):
        coder.decode(np.array([50_000_0], np.uint32), np.array([1]))


def test_byte_bpe_long_words(bpe, monkeypatch):
    """Texts of a single word, through the same recursive queries: any letters, CJK, repeats, and words that a query cuts off early."""
    coder = byte_bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    order = np.random.default_rng(6)
    han, letters = [chr(x) for x in range(0x4E00, 0x5000)], [*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"]
    texts = ["".join(order.choice(letters, 6000)), "a" * 20_000, "ab" * 4000, "".join(order.choice(han, 3000)), " ".join("".join(order.choice(han, 80)) for _ in range(40)), "é" * 999, "-=" * 3000, "the" * 2000]
    texts += ["".join(order.choice([*"etaoinshrdlu"], int(order.integers(30, 400)))) for _ in range(60)]
    want = [bpe.encode_ordinary(t) for t in texts]
    for rows, stepped, split in ((byte_bpe.ROWS, byte_bpe.STEPPED, byte_bpe.SPLIT), (500, 2000, 3), (10, 1, 1)):
        for name, value in (("ROWS", rows), ("STEPPED", stepped), ("SPLIT", split)):
            monkeypatch.setattr(byte_bpe, name, value)
        coder.forget()
        some = slice(None) if stepped > 2000 else slice(8, 24)
        ids, sizes = coder.encode(pa.array(texts[some]))
        assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == want[some]
    coder.forget()


@pytest.mark.parametrize("part", ["encode", "decode"])
def test_pipeline_decodes(spark, monkeypatch, part):
    """The last stage holds decoded ids against the text: ids or bytes that are wrong don't pass."""
    stages = []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.mapInArrow", lambda self, f, schema: stages.append(f) or self.selectExpr("id", "array(1) AS ids"))
    corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame([(1, "some text")], "doc_id long, text string"), "")
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "text": ["some text", ""]})
    assert [b.column("ids").to_pylist()[1] for b in stages[-1](iter([batch]))] == [[]]
    real = getattr(byte_bpe.Coder, part)
    wrong = {"encode": lambda self, *a: (lambda ids, sizes: (ids[::-1].copy(), sizes))(*real(self, *a)), "decode": lambda self, *a: [x[1:] for x in real(self, *a)]}
    monkeypatch.setattr(byte_bpe.Coder, part, wrong[part])
    with pytest.raises(ValueError, match="document 1 "):
        list(stages[-1](iter([batch])))


def test_byte_bpe_odd(spark, odd):
    args = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = byte_bpe.decode(byte_bpe.encode(odd, *args), *args).collect()
    assert sorted(bytes(r["decoded"]) for r in got) == sorted((r["text"] or "").encode() for r in odd.collect())
    assert byte_bpe.round_trip(odd, *args).count() == odd.count() and byte_bpe.round_trip(odd.limit(0), *args).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(odd.limit(0), *args), *args).count() == 0


# 7 and 8


def accuracy(rows, truth, parts, part):
    held = [i for i in truth if zlib.crc32(str(i).encode()) % parts == part]
    assert all(rows[i]["held_out"] for i in held)
    return sum(rows[i]["predicted"] == truth[i] for i in held) / len(held)


def test_quality(spark, sf):
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    assert accuracy(by_id(quality.op7_quality(spark, sf)), truth, 4, 2) >= 0.95


def test_toxicity(spark, sf):
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    assert accuracy(by_id(toxicity.op8_toxicity(spark, sf)), truth, 5, 0) >= 0.9


def test_classifier_slices(spark):
    """A worker scores about 2 MB of text at once, whatever the batch, and a text's score is the same in any slice."""
    from pyspark.sql import functions as F

    from corvid.llm import hashing

    df = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(300)), lambda k: F.hex(F.xxhash64("id", k)).substr(1, 8))).alias("text"))
    size = lambda texts: np.full(len(texts), float(pa.compute.sum(pa.compute.binary_length(texts)).as_py()))
    for found in (hashing.scored(df, size, "doc_id", "text"), hashing.with_scores(df, size, "text", "score")):
        assert 1 << 20 < max(r["score"] for r in found.collect()) <= 2 << 20
    texts = pa.array([r["text"] for r in df.orderBy("doc_id").collect()])
    draw = np.random.default_rng(5)
    model = toxicity.Model(0.1, np.arange(toxicity.SLOTS), draw.normal(size=toxicity.SLOTS).astype(np.float32))
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    assert (np.concatenate([model.score(b.column("text")) for b in hashing.by_bytes([batch], most=hashing.SLICE)]) == model.score(texts)).all()


def test_toxicity_by_hand(spark, sf, docs):
    """Every score is the logistic of the intercept and the weights of a text's distinct features, gathered one by one."""
    from corvid.llm.hashing import TRIM

    model = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    weight = dict(zip(model.slots.tolist(), model.weights.astype(float).tolist(), strict=True))
    assert 0 < len(weight) < toxicity.SLOTS / 20
    got = {r["doc_id"]: r["score"] for r in toxicity.op8_toxicity(spark, sf).collect()}
    full, hashed = (1 << 64) - 1, lambda w: xxhash.xxh64_intdigest(w)
    for i, text in docs:
        words = [w for w in (x.strip(TRIM) for x in re.split("[\t-\r ]+", text.lower())) if w]
        slots = {hashed(w) for w in words} | {hashed("\0" + w[:4]) for w in words}
        for gap, by in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            for a, b in zip(words, words[gap:], strict=False):
                slots.add((hashed(a) * by & full ^ hashed(b) >> 7 ^ hashed(b)) >> 20)
        total = model.bias + sum(weight.get(s, 0.0) for s in {s % toxicity.SLOTS for s in slots})
        assert abs(got[i] - 1 / (1 + np.exp(-np.clip(total, -35, 35)))) < 1e-6


def test_sample_bounds(spark):
    """The sample holds one row a labelled id, however often that repeats, and no more bytes than it may."""
    docs = spark.range(3000).selectExpr("id % 40 as doc_id", "concat('word', id, ' ', repeat(concat('x', id, ' '), 30)) as text")
    labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic", "cast(id % 2 as int) as quality")
    rows, sizes = toxicity.sampled(docs, labels)
    assert len(rows) == sum(sizes) < 40 and {y for _, y in rows} == {0, 1}
    few, _ = toxicity.sampled(docs, labels, max_bytes=rows[0][0].nbytes * 5)
    assert 0 < len(few) < 8 and len(toxicity.sampled(docs, labels, bound=10)[0]) == 10
    assert toxicity.sampled(docs, labels, max_bytes=0)[0] == []
    # without a row to fit on, every score is the share of the class
    none = toxicity.train(docs, labels, max_bytes=0)
    assert len(none.slots) == 0 and abs(1 / (1 + np.exp(-none.bias)) - sizes[1] / sum(sizes)) < 1e-9


def test_factorisation_identity():
    """The linear-time score equals the sum over pairs."""
    order = np.random.default_rng(2)
    model = quality.Model(0.3, order.normal(size=quality.SLOTS + quality.N_STATS).astype(np.float32), order.normal(size=(quality.SLOTS + quality.N_STATS, quality.RANK)).astype(np.float32))
    text, slot, value, stats = quality.features(pa.array(["some words and some more, 12!"]))
    places = [*slot, *range(quality.SLOTS, quality.SLOTS + quality.N_STATS)]
    x = [*value, *stats[0]]
    want = model.bias + sum(model.weights[p] * v for p, v in zip(places, x, strict=True))
    want += sum(float(model.vectors[places[a]] @ model.vectors[places[b]]) * x[a] * x[b] for a, b in itertools.combinations(range(len(x)), 2))
    assert abs(model.logits(text, slot, value, stats)[0] - want) < 1e-2


def test_classifiers_odd(spark, odd, labels):
    for module in (quality, toxicity):
        for some in (labels, labels.limit(0), labels.where("quality = 1")):
            got = module.scores(odd, module.train(odd, some)).collect()
            assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
        assert module.scores(odd.limit(0), module.train(odd.limit(0), labels)).count() == 0
    assert toxicity.drop_toxic(odd, labels.where("toxic = 0")).count() == odd.count()


# 9


def test_mpeg_round_trip(spark, odd):
    rows = mpeg_audio.read_back(mpeg_audio.store(odd)).collect()
    texts = sorted((r["text"] or "").encode() for r in odd.collect())
    want = sorted(hashlib.sha256(t + b" " * (-len(t) % 192 if t else 192)).hexdigest() for t in texts)
    assert sorted(r["payload_sha256"] for r in rows) == want
    assert mpeg_audio.store(odd.limit(0)).count() == 0


def test_mpeg_payload_like_a_tag():
    for n in (64, 65, 66, 1265, 1266, *range(1300, 1420, 7), 2706):
        for size in (192, 1417, 1418, 2880):
            payload = (b"x" * n + b"TAG" + b"y" * size)[:size]
            media = mpeg_audio.pack(payload)
            found = mpeg_audio.parse(media)
            assert mpeg_audio.unpack(media, found) == payload and set(found["tags"]) == {"TXXX:payload"}, (n, size)


def test_mpeg_parse():
    payload = bytes(range(256)) * 40
    data = mpeg_audio.pack(payload)
    found = mpeg_audio.parse(data)
    assert mpeg_audio.unpack(data, found) == payload
    assert found["vbr"]["frames"] == found["frames"] == len(found["offsets"]) and found["crc_failed"] == 0
    assert found["duration_us"] == found["frames"] * 1152 * 1_000_000 // 32000 and found["tags"]["TXXX:payload"] == f"{len(payload)}/{zlib.crc32(payload):08x}"
    broken = bytearray(data)
    broken[found["offsets"][1] + 8] ^= 1
    again = mpeg_audio.parse(bytes(broken))
    assert again["crc_failed"] == 1
    changed = bytearray(data)
    changed[found["offsets"][1] + 100] ^= 1
    for bad, said in ((bytes(broken), again), (bytes(changed), mpeg_audio.parse(bytes(changed))), (data[: found["offsets"][2]], mpeg_audio.parse(data[: found["offsets"][2]]))):
        with pytest.raises(ValueError):
            mpeg_audio.unpack(bad, said)
    torn = data[: found["offsets"][2]] + b"\xff\xf9junk" + data[found["offsets"][2] :] + b"TAG" + b"name".ljust(125, b"\0")
    again = mpeg_audio.parse(torn)
    assert again["frames"] == found["frames"] and again["skipped"] == 6 and again["tags"]["TIT2"] == "name"
    for bad in (b"", b"\xff" * 50, b"ID3", b"no audio here"):
        assert mpeg_audio.parse(bad)["frames"] == 0


def test_mpeg_other_streams():
    # MPEG-2 layer III, 64 kbit/s at 22,050 Hz: 208 bytes a frame of 576 samples; MPEG-1 layer II, 64 kbit/s at 48 kHz: 192 bytes
    three, two = bytes([0xFF, 0xF3, 0x80, 0xC0]) + bytes(204), bytes([0xFF, 0xFD, 0x44, 0x00]) + bytes(188)
    a, b = mpeg_audio.parse(three * 5), mpeg_audio.parse(two * 3)
    assert (a["frames"], a["samples"], a["rate"], a["layer"]) == (5, 2880, 22050, 3)
    assert (b["frames"], b["samples"], b["rate"], b["layer"]) == (3, 3456, 48000, 2)


def test_mpeg_rate_changes():
    """A stream that changes its sampling rate lasts as long as its parts together."""
    low, high = bytes([0xFF, 0xFD, 0x48, 0x00]) + bytes(284), bytes([0xFF, 0xFD, 0x44, 0x00]) + bytes(188)
    found = mpeg_audio.parse(low * 2 + high * 3)
    assert mpeg_audio.header(low, 0).rate == 32000 and mpeg_audio.header(high, 0).rate == 48000
    assert found["frames"] == 5 and found["duration_us"] == 2 * 36_000 + 3 * 24_000


def test_mpeg_query(spark, sf, docs):
    """Every column of the query that its contract fixes, by plain Python."""
    got = by_id(mpeg_audio.op9_mpeg_audio(spark, sf))
    assert len(got) == len(docs)
    for i, text in docs:
        data = text.encode()
        payload = data + b" " * (-len(data) % 192 if data else 192)
        media = mpeg_audio.pack(payload)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"], r["media_bytes"]) == (len(data), len(payload), zlib.crc32(payload[-16:]), len(media))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["media_sha256"] == hashlib.sha256(media).hexdigest()
        frames = -(-len(payload) // (mpeg_audio.SIZES[-1] - mpeg_audio.BODY))
        assert r["frames"] == frames and r["duration_us"] == frames * 36_000 and r["feature"].startswith(f"mpeg1 layer 3 32000 Hz Xing frames={frames} samples={1152 * frames} ")
    assert mpeg_audio.read_back(mpeg_audio.store(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_mpeg_features(spark):
    df = spark.createDataFrame([(1, bytearray(mpeg_audio.pack(b"x" * 4000))), (2, None), (3, bytearray(b""))], "id long, media binary")
    rows = by_id(mpeg_audio.media_features(df), "id")
    assert rows[1]["frames"] == len(rows[1]["offsets"]) == 3 and rows[2]["frames"] is None and rows[3]["frames"] == 0


# 10


def test_chat_fold(spark):
    events = [
        (1, 0, 0, "delta", "user", "hi"), (1, 1, 1, "delta", "assistant", "wro"), (1, 1, 2, "delta", "assistant", "ng"), (1, 2, 3, "delta", "user", "later"),
        (1, 1, 4, "regenerate", "assistant", None), (1, 1, 5, "delta", "assistant", "right"), (1, 3, 6, "delta", "user", "after"),
        (1, 0, 7, "edit", "user", "hello"), (1, 4, 8, "delta", "user", "gone"), (1, 4, 9, "delete", "user", None), (2, 0, 0, "delta", None, None),
    ]
    got = chat.fold(spark.createDataFrame(events, "conv long, msg long, seq long, kind string, role string, payload string")).orderBy("conv", "msg").collect()
    assert [(r["conv"], r["msg"], r["role"], r["text"]) for r in got] == [(1, 0, "user", "hello"), (1, 1, "assistant", "right"), (1, 3, "user", "after"), (2, 0, "", "")]


def replay(events):
    """The standing messages of a log, event by event."""
    held, begun = {}, {}
    for conv, msg, seq, kind, role, payload in sorted(events, key=lambda e: (e[0], e[2])):
        key = (conv, msg)
        if key not in held:
            held[key], begun[key] = [role or "", ""], seq
        if kind == "delta":
            held[key][1] += payload or ""
        elif kind == "edit":
            held[key][1] = payload or ""
        elif kind == "delete":
            held[key].append("gone")
        else:
            held[key][1] = ""
            for other in held:
                if other[0] == conv and other[1] > msg and begun[other] < seq:
                    held[other].append("gone")
    return sorted((c, m, x[0], x[1]) for (c, m), x in held.items() if len(x) == 2)


def test_chat_fold_replay(spark):
    """Random logs fold to what a plain replay leaves; so does the log that as_events makes, with its columns in any company."""
    order = np.random.default_rng(9)
    events = []
    for conv in range(60):
        seq = 0
        for _ in range(int(order.integers(1, 40))):
            seq += int(order.integers(1, 3))
            kind = str(order.choice(["delta", "delta", "delta", "edit", "regenerate", "delete"], p=[0.3, 0.3, 0.22, 0.08, 0.07, 0.03]))
            msg = int(order.integers(0, 6))
            events.append((conv, msg, seq, kind, f"r{msg % 2}", None if order.random() < 0.1 else f"<{seq}&"))
    kinds = "conv long, msg long, seq long, kind string, role string, payload string"
    df = spark.createDataFrame(events, kinds)
    got = sorted((r["conv"], r["msg"], r["role"], r["text"]) for r in chat.fold(df.selectExpr("*", "1 as text", "2 as log", "3 as turn")).collect())
    assert got == replay(events) and len(got) > 60
    assert chat.fold(df.limit(0)).count() == 0 and chat.read_back(chat.render(chat.fold(df.limit(0)))).count() == 0
    rows = [(c, k, "assistant" if k % 2 else "user", "t\u00e9xt <&> " * int(order.integers(0, 4)) + str(k)) for c in range(20) for k in range(int(order.integers(1, 9)))]
    log = chat.as_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as payload", "0 as n", "9 as msg"))
    told = [tuple(r) for r in log.select(*chat.EVENTS).collect()]
    assert {e[3] for e in told} == {"delta", "edit", "regenerate", "delete"} and len(told) > 2 * len(rows)
    assert len({(e[0], e[1]) for e in told}) > len(rows)
    folded = sorted((r["conv"], r["msg"], r["role"], r["text"]) for r in chat.fold(log).collect())
    assert folded == replay(told) and [x[2:] for x in folded] == [(r, t) for _, _, r, t in sorted(rows, key=lambda x: x[:2])]


def test_chat_round_trip(spark):
    texts = ["", "&lt;", "<turn role=\"assistant\">", "</turn>\n", "\\### Assistant: </turn> ok", "&amp;quot;\"", "\n\n", "é😀" * 50, None]
    rows = [(1, k, r, t) for k, (t, r) in enumerate(itertools.product(texts, ["assistant", 'u"s<er&', None]))] + [(1, 0, "assistant", ""), (None, None, "user", "x")]
    rendered = chat.render(chat.fold(chat.as_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    back = by_id(chat.read_back(rendered), "conv")
    want = sorted([(k, r or "", t or "") for c, k, r, t in rows if c == 1], key=lambda x: x[0])
    assert sorted((r["role"], r["text"]) for r in back[1]["turns"]) == sorted((r, t) for _, r, t in want)
    assert "".join(back[1]["loss"]) == "".join(t for _, r, t in want if r == "assistant") and back[1]["mask_fits"]
    one = by_id(rendered, "conv")[1]
    for m, loss in zip(one["mask"], back[1]["loss"], strict=True):
        assert one["formatted"][m["start"] : m["end"]].replace("&lt;", "<").replace("&amp;", "&") == loss
    assert back[None]["turns"][0]["text"] == "x"


# Pipeline


def test_pipeline(spark, sf, docs):
    kept = set(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").toPandas()["doc_id"])
    at = spark.read.parquet(f"{sf}/documents.parquet")
    texts = dict(docs)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    before = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.written(stage(spark, at, sf), "test")
        assert at.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = [r["doc_id"] for r in at.select("doc_id").collect()]
        if name == "exact dedup":
            first = {}
            for i in sorted(kept):
                first.setdefault(norm(texts[i]), i)
            assert sorted(now) == sorted(first.values())
        if name == "simhash near-dedup":
            left = sorted(kept)
            assert sorted(now) == sorted({left[c] for c in brute_classes([brute_print(texts[i]) for i in left])})
        if name == "source mixing":
            assert set(now) == kept
        kept = set(now)
        if name == "source mixing":
            assert {i: now.count(i) for i in kept} == brute_mix([(r["doc_id"], r["source"], r["text"]) for r in before], corpus_pipeline.REPEATS)
        before = at.collect()
    bpe = tiktoken_encoding()
    want = sorted((r["doc_id"], tuple(bpe.encode_ordinary(r["text"] or ""))) for r in before)
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in got) == want and all(r["n_tokens"] == len(r["ids"]) for r in got)


def brute_mix(rows, limit, seed=42):
    """How often each id is drawn when every source gets one whole epoch at least."""
    sources = {}
    for i, s, t in rows:
        sources.setdefault(s, []).append((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))))
    tokens = {s: sum(n for _, n in some) for s, some in sources.items()}
    plan = mixing.plan(tokens, mixing.exponent_for_repeats(list(tokens.values()), limit))
    out = {}
    for s, some in sources.items():
        _, whole, rest = plan[s]
        upto = 0
        for i, n in sorted(some, key=lambda x: hashlib.md5(f"{seed}:{whole}:{x[0]}".encode()).hexdigest()):
            upto += n
            out[i] = whole + (rest > 0 and upto <= rest)
    return out


def tiktoken_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_odd(spark, odd, tmp_path, labels, name, stage):
    """Every stage on nulls in every column, repeated rows, clashing names and no rows at all."""
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, odd.limit(0)):
        got = stage(spark, docs, str(tmp_path))
        if name == corpus_pipeline.STAGES[-1][0]:
            assert got.columns == ["doc_id", "ids", "n_tokens"] and got.count() == docs.count()
        else:
            assert got.columns == docs.columns and set(map(str, got.collect())) <= set(map(str, docs.collect()))


def test_pipeline_odd(spark, odd, tmp_path, labels):
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "ids", "n_tokens"] and 0 < got.count() < odd.count()


def test_shared_dir_needs_a_cluster_setting():
    """On more than one machine a scratch folder must be named; none is made up."""
    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master, getConf = "spark://somewhere:7077", staticmethod(Conf)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        corpus_pipeline.written.__globals__["shared_dir"](Session)
