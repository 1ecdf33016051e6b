"""Each corpus operator on small hand-made tables, against brute force or the library it must equal."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from clickweave.llm import bpe, counts, jaccard, mixing, pii, quality, rules, tiling, tokenfiles, urls
from clickweave.llm.pieces import load, stored

WORD_FILE, BYTE_FILE = stored("word_bpe_49k.json"), stored("byte_bpe_50k.json")
rng = random.Random(7)
VOCAB = ["".join(rng.choice("aeiourstlnm") for _ in range(rng.randint(2, 8))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n)) + "."


BASE = prose(120, 1)
ODD = "Don't stop: Straße ÀÉ 12½ İ Σς 日本語 é <|endoftext|> ''ll !!! \x85\n\n tail"
CASES = [
    (1, BASE), (2, BASE), (3, BASE + " more"), (None, prose(60, 2)), (None, None), (4, None), (5, ""), (6, " \n\t "),
    (7, "one"), (7, "two words"), (8, prose(3000, 3)), (9, ODD), (10, "x" * 5000), (11, prose(40, 4) + "\n" + prose(40, 4)),
    (12, "spam ### " * 40), (13, prose(30, 5) + " mail me: a.b@mail.example.com, +1 (555) 123-4567 or 10.0.0.1, card 4111 1111 1111 1111"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 5) for i, t in CASES]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, k1 string, _rules int").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_token_files_equal_library(spark, docs, none):
    manifest, folder = tokenfiles.write_shards(docs, BYTE_FILE)
    found = tokenfiles.read_by_key(docs.select("doc_id"), manifest, folder).collect()
    tok = Tokenizer.from_file(BYTE_FILE)
    want = Counter()
    for i, t in CASES:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    assert [r.doc_id for r in ordered if r.doc_id is not None] == sorted(i for i, _ in CASES if i is not None)
    assert tokenfiles.read_by_key(spark.createDataFrame([(99,)], "doc_id long"), manifest, folder).count() == 0
    assert tokenfiles.read_by_key(none, *tokenfiles.write_shards(none, BYTE_FILE)).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    table = tokenfiles.PerfectHash.build(keys)
    assert sorted(table.number(keys).tolist()) == list(range(len(keys)))


def test_quality_scores(spark, none):
    good = [(i, prose(80, i)) for i in range(120)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(60, i).split())) for i in range(60)]
    d = spark.createDataFrame(good + bad + [(None, None), (5000, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    found = quality.quality_scores(d, labels).collect()
    assert len(found) == 182 and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 2000]
    assert {r.doc_id for r in held} == {i for i, _ in good + bad if zlib.crc32(str(i).encode()) % 4 == 2}
    p, n = [r.score for r in held if r.doc_id < 1000], [r.score for r in held if r.doc_id >= 1000]
    assert np.mean([a > b for a in p for b in n]) > 0.95
    assert quality.quality_scores(none, labels).count() == 0
    assert {r.score for r in quality.quality_scores(d, labels.where("quality = 9")).collect()} == {0.5}


def brute_rules(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(x in "#*$%&|<>" for x in t or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules_base_and_cascade(docs, none):
    found = rows_of(rules.quality_report(docs), "doc_id", *rules.BASE)
    assert found == Counter((i, *brute_rules(t)) for i, t in CASES)
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 8, 13} and 12 not in {r.doc_id for r in kept.collect()}
    assert rules.keep_good(none).count() == 0


def shingles(t, n):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def brute_components(texts, n, percent):
    sets = [shingles(t, n) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    return sets, [root(i) for i in range(len(sets))]


def edited(text, seed, n):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = r.choice(VOCAB)
    return " ".join(w)


def test_linked_sets_share_a_signature():
    """No link is lost: random sets at and above the limit, of many sizes, in two families of signatures."""
    g = np.random.default_rng(3)
    for percent in (80, 85, 95):
        for size in [*range(2, 40), 75, 150, 400]:
            for seed in (0, 1):
                a = np.unique(g.integers(0, 1 << 63, size).astype(np.uint64))
                most = len(a) * (100 - percent) // (100 + percent) if seed else len(a) * (100 - percent) // 100
                b = np.unique(np.concatenate([a[most:], g.integers(0, 1 << 63, most if seed else 0).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if len(a) == both == len(b) or 100 * both < percent * (len(a) + len(b) - both):
                    continue
                sig, who = jaccard.signatures_of([a, b], percent, seed)
                assert set(sig[who == 0].tolist()) & set(sig[who == 1].tolist()), (percent, size, seed)


def test_shingles_side_by_side():
    texts = [b"", b" ", b"A b", b"a B c d", b"a b c d e f a b c d", "é x\x85y z q".encode()] * 2
    for n in (1, 4, 5):
        for text, got in zip(texts, jaccard.shingle_sets(texts, n)):
            w = text.lower().split()
            grams = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
            assert len(got) == len(grams) and (got == jaccard.shingle_set(text, n)).all()
    assert (jaccard.shingle_set(b"a b c", 4) == jaccard.shingle_set(b"A  B\nC", 4)).all()
    assert jaccard.shingle_set(b"a b c", 4) != jaccard.shingle_set(b"a b c c", 4)


def test_jaccard_equals_brute_force(spark, docs, none, monkeypatch):
    passage = prose(60, 50)
    texts = [t for _, t in CASES] + [edited(BASE, s, s % 9) for s in range(60)]
    texts += [passage + " " + prose(25, 300 + s) for s in range(60)] + [edited(prose(9, 60), s, 1) for s in range(30)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for n, percent, stars, block in ((4, 85, 3, 128), (5, 80, 0, 4), (5, 80, 1, 128)):  # stars alone, blocks at once, both
        monkeypatch.setattr(jaccard, "STARS", stars)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(d, n, percent).collect()}
        sets, roots = brute_components(texts, n, percent)
        least = {}
        for i, r in enumerate(roots):
            least[r] = min(least.get(r, i), i)
        assert found == {i: (len(sets[i]), least[r]) for i, r in enumerate(roots)}
    assert jaccard.near_duplicates(docs).count() == len(CASES)
    assert jaccard.near_duplicates(none).count() == 0


def test_token_counts_and_bpe_equal_library(docs, none):
    tok = Tokenizer.from_file(WORD_FILE)
    want = Counter()
    for i, t in CASES:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode())] += 1
    assert rows_of(bpe.encoded(docs, WORD_FILE), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    for size in (7, 1 << 15):
        got = rows_of(counts.token_counts(docs, WORD_FILE, size), "doc_id", "n_bytes", "n_tokens")
        assert got == Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in CASES)
    assert bpe.encoded(none, WORD_FILE).count() == counts.token_counts(none, WORD_FILE).count() == 0
    back = bpe.decoded(bpe.encoded(docs.where("doc_id = 7"), WORD_FILE), WORD_FILE).collect()
    assert {r.text for r in back} == {"one</w>", "two</w> words</w>"}


def test_pieces_equal_library_on_random_text():
    p, machine = load(WORD_FILE), counts.compiled(WORD_FILE)
    r = random.Random(11)
    for _ in range(300):
        t = "".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x250, 0x3000), r.randrange(0x10000, 0x1F000)])) for _ in range(30))
        ids = p.library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(bpe.encode(t, WORD_FILE), "<u4").tolist() == ids
        assert counts.total(counts.chunk_map(t, machine), machine) == len(ids)


def test_urls(spark):
    listed = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
    cases = {
        "http://a.EXAMPLE.com/en/1": ("block", "example.com/en/"), "https://www.example.com/en/x?y": ("allow", "www.example.com/en/"),
        "http://badexample.com/en/": ("allow", "com/"), "http://x.net/es/": ("block", "net/es/"), "http://x.net/es": ("allow", None),
        "http://com": ("allow", None), "no scheme": ("allow", None), None: ("allow", None), "": ("allow", None), "http://x.net?/es/": ("allow", None),
    }
    pages = spark.createDataFrame([(i, u, "a") for i, u in enumerate(cases)] + [(0, next(iter(cases)), "b")], "page_id long, url string, host string")
    found = urls.url_report(pages, urls.rule_table(spark, listed)).collect()
    want = list(cases.values())
    assert Counter((r.page_id, r.verdict, r.rule) for r in found) == Counter((i, *v) for i, v in enumerate(want)) + Counter([(0, *want[0])])
    out = urls.judge_urls(pages, urls.rule_table(spark, listed))
    assert out.columns[:3] == pages.columns and out.count() == len(cases) + 1
    many = [("block", f"h{i}.org", f"/p{i % 7}/") for i in range(3000)]
    got = urls.url_report(spark.createDataFrame([(i, f"http://z.h{i}.org/p{i % 7}/q") for i in range(4000)], "page_id long, url string"), urls.rule_table(spark, many))
    assert rows_of(got, "verdict") == Counter({("block",): 3000, ("allow",): 1000})
    assert urls.url_report(pages.limit(0), urls.rule_table(spark, listed)).count() == 0
    assert rows_of(urls.url_report(pages, urls.rule_table(spark, listed).limit(0)), "verdict") == Counter({("allow",): len(cases) + 1})


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(t):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, t or ""):
            digits = re.sub(r"\D", "", m[0])
            ok = kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
            ok = ok or (kind == "card" and 16 <= len(digits) <= 19 and pii.luhn(digits)) or (kind == "phone" and 8 <= len(digits) <= 15)
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_spans_and_text():
    r = random.Random(3)
    alphabet = "ab1.@-+_%() 0123456789\n"
    for _ in range(3000):
        t = "".join(r.choice(alphabet) for _ in range(50))
        assert pii.base_spans(t) == brute_spans(t)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii_terms_and_sanitising(spark, docs, none):
    told = [(100 + i, f"{prose(20, 400 + i)} Zanzibert wrote from zed@corp.example.com {prose(20, 500 + i)}") for i in range(6)]
    others = [(200 + i, f"{prose(30, 600 + i)} mail u{i}@corp.example.com {prose(9, 700 + i)}") for i in range(40)]
    d = spark.createDataFrame(told + others + [r for r in CASES], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.spans_report(d).where("doc_id >= 100").collect()}
    for i, t in told:
        at = t.index("Zanzibert")
        assert f"term:{at}:{at + 9}" in found[i].spans and found[i].n_email == 1
    assert not any("term" in found[i].spans for i, _ in others)
    report = pii.spans_report(docs)
    want = Counter((i, ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(t))) for i, t in CASES)
    assert rows_of(report, "doc_id", "spans") == want
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns
    text = {r.doc_id: r.text for r in clean.collect()}
    assert text[13].endswith("mail me: [EMAIL], [PHONE] or [IP], card [CARD]") and text[4] is None and text[8] == CASES[10][1]
    assert pii.spans_report(none).count() == pii.sanitised(none).count() == 0


def test_pii_secrets(spark):
    """Literals next to a word that is always next to literals; the same shapes elsewhere stay."""
    r = random.Random(9)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(30)]
    held = [(i, f'{prose(30, 800 + i)} {"Token" if i % 2 else "token"} = "{h}" {prose(30, 900 + i)} call +1 555 123 {i:04d}.') for i, h in enumerate(hexes)]
    plain = [(100 + i, prose(60, 1000 + i) + f" abcdefghijklmnop{i} iiiiiiiiiiiiiiii1 {prose(20, 1100 + i)}") for i in range(40)]
    d = spark.createDataFrame(held + plain, "doc_id long, text string").repartition(4)
    found = {x.doc_id: x for x in pii.spans_report(d).collect()}
    for i, t in held:
        at = t.index('"') + 1
        assert f"secret:{at}:{at + 40}" in found[i].spans.split(",") and found[i].n_secret == 1 and found[i].n_phone == 1
    assert all(found[i].n_spans == 0 for i, _ in plain)
    clean = {x.doc_id: x.text for x in pii.sanitised(d).collect()}
    assert all('= "[SECRET]"' in clean[i] and "[PHONE]" in clean[i] for i, _ in held) and all(clean[i] == t for i, t in plain)


def test_pii_disclosure_counts_equal_brute_force(spark):
    """Shares of information by plain counting over all texts, with terms that stop early among them."""
    rows = [f"{prose(6, 40 + i % 7)} {'zarko' if i % 3 else 'common'} near u{i % 4}@mail.example.com {prose(5, 60 + i)}" for i in range(60)]
    rows += [prose(25, 2000 + i) + " common word" for i in range(50)] + ["", None]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(3)
    got = {(x.entity, x.term): round(x.disclosure, 9) for x in pii.disclosing_terms(d, 2, 0.5).collect()}
    contexts, mentions, of_entity = {}, {}, {}
    for t in rows:
        ms = list(pii._TERM.finditer(t or ""))
        words = [m[0].lower() for m in ms]
        for i, w in enumerate(words):
            contexts.setdefault(w, set()).add(tuple(words[max(0, i - 2) : i + 3]))
        for span in pii.base_spans(t or ""):
            at = sum(m.start() < span[1] for m in ms)
            near = [i for i in range(max(0, at - pii.WINDOW), min(len(ms), at + pii.WINDOW)) if ms[i].end() <= span[1] or ms[i].start() >= span[2]]
            e = pii.entity_of(t, span)
            of_entity.setdefault(e, set()).add(tuple(words[i] for i in near))
            for i in near:
                mentions.setdefault((e, words[i]), set()).add(tuple(words[max(0, i - 2) : i + 3]))
    total = sum(map(len, of_entity.values()))
    want = {}
    for (e, w), own in mentions.items():
        ic = -math.log(len(of_entity[e]) / total)
        share = 1 + math.log(len(own) / max(len(contexts[w]), len(own))) / ic
        if len(own) >= 2 and share >= 0.5:
            want[e, w] = round(share, 9)
    assert got == want and len(want) > 3


def test_mixing_base_and_probability(spark, docs, none):
    found = mixing.scored(docs).collect()
    train = Counter()
    for i, t in CASES:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            train.update((t or "").encode().lower().split())
            train[None] += 1
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, t in CASES:
        words = (t or "").encode().lower().split() + [None]
        want[i, len(words), sum(train[w] > 0 for w in words), n, round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words), 5)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == want
    assert all(r.score < 0 for r in found) and mixing.scored(none).count() == 0
    code = mixing.Code.build(np.array([5, 1, 1, 7]), 0)
    assert sum(2.0 ** -int(x) for x in code.length) == 1.0


def test_tiling(spark, docs, none):
    item = prose(40, 90).split()
    bench = spark.createDataFrame([("a", " ".join(item)), ("b", prose(35, 91)), ("c", None), ("d", "")], "item_id string, text string")
    swapped = " ".join(item[20:] + ["zzz"] * 9 + item[:20])
    rows = [(1, prose(50, 92) + " " + " ".join(item).upper() + prose(50, 93)), (2, swapped), (3, " ".join(item[:8]) + prose(90, 94)), (None, None), (4, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    found = tiling.contamination(d, bench).collect()
    assert {(r.doc_id, r.item) for r in found} == {(1, "a"), (2, "a")}
    assert {r.doc_id: len(r.tiles) for r in found} == {1: 1, 2: 2}
    clean = tiling.decontaminated(d, bench)
    assert clean.columns == d.columns and {r.doc_id for r in clean.collect()} == {3, 4, None}
    assert tiling.contamination(none, bench).count() == 0 and tiling.decontaminated(docs, bench.limit(0)).count() == len(CASES)
    r = random.Random(4)
    for _ in range(200):
        p, t = (np.array([r.randrange(4) for _ in range(r.randrange(1, 30))], np.uint64) for _ in range(2))
        tiles = tiling.greedy_tiles(p, t, 3)
        used_p, used_t = [i + k for n, i, _ in tiles for k in range(n)], [j + k for n, _, j in tiles for k in range(n)]
        assert len(set(used_p)) == len(used_p) and len(set(used_t)) == len(used_t)
        assert all((p[i : i + n] == t[j : j + n]).all() and n >= 3 for n, i, j in tiles)


def test_pipeline_stages(spark, tmp_path, docs):
    item = prose(40, 90)
    rows = [(i, t, "en", "s", 1) for i, t in CASES] + [(50, prose(60, 95) + " " + item, "en", "s", 1)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([("a", item)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    d = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, folder)
        if name != "token_ids":
            assert out.columns == d.columns
            d = out.checkpoint() if spark.sparkContext.getCheckpointDir() else spark.createDataFrame(out.collect(), out.schema)
            left[name] = {r.doc_id for r in d.collect()}
    assert left["quality_rules"] >= {1, 2, 3, 50} and 12 not in left["quality_rules"]
    assert {1} == left["near_copies"] & {1, 2, 3} and 50 in left["near_copies"]
    assert 50 not in left["benchmark_leaks"] and left["personal_data"] == left["benchmark_leaks"]
    found = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in found.collect()} == left["personal_data"]
    assert found.select(F.min(F.size("ids") - F.col("n_tokens"))).first()[0] == 0


def test_a_term_over_its_number_leaves_one_row_a_task():
    """Whatever the number of its contexts: no contexts of terms that are dropped anyway are handed on."""
    from types import SimpleNamespace

    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    text = " ".join(f"{w} often {w}x" for w in words) + " seldom here"
    batch = pa.RecordBatch.from_pydict({"text": pa.array([text, text])})
    got = pa.Table.from_batches(list(pii._emit_contexts(iter([batch]), SimpleNamespace(value={"often": 200, "seldom": 2, "never": 1}))))
    assert [r["context"] for r in got.to_pylist() if r["term"] == "often"] == [None]
    assert len([r for r in got.to_pylist() if r["term"] == "seldom" and r["context"] is not None]) == 1
    assert got.num_rows == 2


def test_workers_forget_words_after_a_task(spark, docs):
    """Workers serve other jobs next; what they remember of their texts' words would stay beside those."""
    path = stored("word_bpe_49k.json")
    assert bpe.encoded(docs, path).count() == docs.count()
    bpe.encoded(docs, path).collect()

    def remembered(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(bpe._store(path))], pa.int32())})

    assert {r["n"] for r in spark.range(64).repartition(8).mapInArrow(remembered, "n int").collect()} == {0}


def test_mixing_base_counts_words_beyond_the_vocabulary(spark, monkeypatch):
    """A vocabulary of a few words: the base score and the known words are those of all words all the same."""
    rows = [(i, " ".join(f"w{(i * k) % 37}" for k in range(1, 40))) for i in range(60)] + [(60, None), (61, "w1 stranger")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    whole = {r["doc_id"]: tuple(r) for r in mixing.scored(d).select(*columns).collect()}
    monkeypatch.setattr(mixing, "HEAD", 5)
    monkeypatch.setattr(mixing, "FREQUENT", 3)
    few = {r["doc_id"]: tuple(r) for r in mixing.scored(d).select(*columns).collect()}
    assert whole.keys() == few.keys()
    for k in whole:
        assert whole[k][:5] == few[k][:5] and whole[k][5] == pytest.approx(few[k][5])
