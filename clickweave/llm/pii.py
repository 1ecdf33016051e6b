"""Personal data: pattern spans, and terms that disclose them by corpus co-occurrence.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Protected entities are their distinct
values, and the kind of literals: runs of letters and digits that carry more information than the corpus' own
text, by a character-pair model counted over all texts. Terms are the words within a window around
an entity's mention. Over the whole corpus, contexts are counted once each (a context is a term with its
neighbours, by hash, so copies of a text add nothing): n(t, e) contexts of term t next to entity e, n(t)
contexts of t anywhere, n(e) contexts of e, N contexts of all entities of e's sort (values or kinds). With
p(e | t) = n(t, e) / n(t) and IC(e) = -log(n(e) / N), a term's pointwise information about e is
IC(e) + log p(e | t); it discloses e when that reaches the share ``threshold`` of IC(e) and n(t, e) reaches
``support``. In documents that mention a value its disclosing terms become spans of kind "term", unless a base
span covers them; a literal next to a term that discloses literals becomes a span of kind "secret". Sanitising generalises base spans and secrets to their
kind, in brackets, and removes disclosing terms.

Counting n(t) stops early: a task that has met more contexts of a term than its threshold allows drops the term.

Matching is leftmost, without overlap, per kind, and linear in the text: addresses are found from
their "@", number patterns start only where a run of digits starts.

Defined cases: a null or empty text has no spans; equal texts get equal spans; null ids stay; an
empty table gives an empty result; other columns are untouched by ``sanitised``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import column, fresh, portions, strings, text_key, texts, utf8
from clickweave.operators.joins import lookup_join
from clickweave.scratch import pin

KINDS = ["email", "ip", "card", "phone"]
#: Words on either side of a mention; contexts a term needs with an entity; share of IC to reach;
#: terms looked for in one pass over the texts (more are taken in further passes).
WINDOW, SUPPORT, THRESHOLD, TERMS_A_PASS = 8, 3, 0.9, 500_000

# fixed values: the patterns of the contract, written so that no start is tried twice
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_LITERAL = re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*[0-9])(?=[0-9_+/=-]*[A-Za-z])[A-Za-z0-9_+/=-]{16,}")
#: Bits that a literal has at least, in all and as a multiple of what the corpus' characters carry on average.
LITERAL_BITS, LITERAL_RATE = 64.0, 1.2
#: Prefix of entities that are kinds, not values.
KIND = "kind:"
_TERM = re.compile(r"[^\W\d_]{3,}")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        if found:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = found.end()
                yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the four kinds, by kind as listed and start."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def entity_of(text: str, span: Span) -> str:
    kind, a, b = span
    raw = text[a:b]
    return f"{kind}:{raw.lower()}" if kind in ("email", "ip") else kind + ":" + re.sub(r"[^0-9]", "", raw)


# ---- characters ------------------------------------------------------------

class Characters:
    """Bits of a byte after the one before it, from counts over all texts; at most 65,536 numbers."""

    def __init__(self, counts: np.ndarray):
        pairs = counts.reshape(256, 256).astype(np.float64)
        self.bits = -np.log2((pairs + 1) / (pairs.sum(axis=1, keepdims=True) + 256))
        self.mean = float((pairs * self.bits).sum() / max(1.0, pairs.sum()))

    def literals(self, text: str) -> list[tuple[int, int]]:
        """Runs that carry enough information to be secrets."""
        out = []
        for m in _LITERAL.finditer(text):
            raw = np.frombuffer(m[0].encode(), np.uint8)
            total = float(self.bits[raw[:-1], raw[1:]].sum())
            if total >= max(LITERAL_BITS, LITERAL_RATE * self.mean * (len(raw) - 1)):
                out.append(m.span())
        return out


def characters(rows: DataFrame) -> Characters:
    """Byte pairs of all texts; each task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in portions(batches):
            raw = np.frombuffer(b"".join(utf8(batch)), np.uint8).astype(np.uint16)
            total += np.bincount(raw[:-1] * 256 + raw[1:], minlength=1 << 16)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(some.astype(np.int32)), "n": pa.array(total[some])})

    found = rows.select("text").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << 16, np.int64)
    counts[found["pair"].to_numpy()] = found["n"].to_numpy()
    return Characters(counts)


# ---- co-occurrence ---------------------------------------------------------

def _context(words: list[str], i: int) -> int:
    """Hash of a term with two words on either side, signed."""
    return xxhash.xxh3_64_intdigest(" ".join(words[max(0, i - 2) : i + 3]).encode()) - (1 << 63)


def _around(text: str, chars: Characters) -> Iterator[tuple[Span, list[re.Match], list[int]]]:
    """Each base span and literal, the words of the text, and the numbers of those within the window."""
    spans = base_spans(text)
    taken = [(a, b) for _, a, b in spans]
    spans += [("literal", a, b) for a, b in chars.literals(text) if all(b <= x or y <= a for x, y in taken)]
    if not spans:
        return
    matches = list(_TERM.finditer(text))
    places = [m.start() for m in matches]
    for span in spans:
        at = bisect_left(places, span[1])
        around = range(max(0, at - WINDOW), min(len(matches), at + WINDOW))
        yield span, matches, [i for i in around if matches[i].end() <= span[1] or places[i] >= span[2]]


def _mentions(text: str, chars: Characters) -> Iterator[tuple[str, int, str, int]]:
    """(entity, its context, term, the term's context) around each mention, of its value and of its kind."""
    words: list[str] = []
    for span, matches, near in _around(text, chars):
        words = words or [m[0].lower() for m in matches]
        own = xxhash.xxh3_64_intdigest(" ".join(words[i] for i in near).encode()) - (1 << 63)
        # kinds are counted for the information of each; a base kind is told by what it is generalised to anyway
        entity = KIND + span[0]
        yield entity, own, "", 0
        if span[0] != "literal":
            entity = entity_of(text, span)
            yield entity, own, "", 0
        for i in near:
            yield entity, own, words[i], _context(words, i)


def _emit_mentions(batches: Iterator[pa.RecordBatch], chars) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches):
        rows: set = set()
        for text in strings(batch):
            rows.update(_mentions(text, chars.value))
        cols = list(zip(*rows)) or [[], [], [], []]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(["entity", "own", "term", "context"], cols, types)})


def _emit_contexts(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    """Contexts of the wanted terms; one without a context says that the term has more than it may have."""
    open_, seen, over = dict(wanted.value), {}, []
    for batch in portions(batches):
        for text in strings(batch):
            words = _TERM.findall(text.lower())
            if open_.keys().isdisjoint(words):
                continue
            for i, w in enumerate(words):
                most = open_.get(w)
                if most is None:
                    continue
                own = seen.setdefault(w, set())
                own.add(_context(words, i))
                if len(own) > most:
                    over.append(w)
                    del open_[w], seen[w]
    yield pa.RecordBatch.from_pydict({"term": pa.array(over, pa.string()), "context": pa.array([None] * len(over), pa.int64())})
    for w, own in seen.items():
        yield pa.RecordBatch.from_pydict({"term": pa.array([w] * len(own), pa.string()), "context": pa.array(list(own), pa.int64())})


def disclosing_terms(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD, chars: Characters | None = None) -> DataFrame:
    """entity, term and its disclosure (share of the entity's information), over all texts."""
    rows = texts(docs).select("text")
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(chars or characters(rows))
    found = rows.where(F.col("text").rlike("@|[0-9]")).mapInArrow(partial(_emit_mentions, chars=sent), "entity string, own long, term string, context long")
    seen = pin(found.distinct(), "mentions")
    of_kind = F.col("entity").startswith(KIND)
    of_entity = seen.where("term = ''").groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    total = of_entity.agg(*[F.sum(F.when(c, F.col("n_e"))).alias(n) for n, c in (("kinds", of_kind), ("values", ~of_kind))]).first()
    pairs = seen.where("term <> ''").select("entity", "term", "context").distinct()
    pairs = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te")).where(F.col("n_te") >= support)
    n = F.when(of_kind, F.lit(float(total["kinds"] or 1))).otherwise(F.lit(float(total["values"] or 1)))
    pairs = pairs.join(of_entity, "entity").withColumn("ic", -F.log(F.col("n_e") / n))
    pairs = pin(pairs.withColumn("most", F.floor(F.col("n_te") * F.exp((1 - threshold) * F.col("ic")) + 1e-9)), "term-pairs")
    terms = pairs.groupBy("term").agg(F.max("most").alias("most"))
    terms = pin(terms.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(1 << 20))), "terms")
    parts = -(-terms.count() // TERMS_A_PASS)
    counts = spark.createDataFrame([], "term string, n_t long")
    for part in range(parts):
        # one bounded share of the terms at a time, each against all texts
        own = terms.where(F.col("part") % parts == part).select("term", "most").collect()
        wanted = spark.sparkContext.broadcast({r["term"]: r["most"] for r in own})
        met = rows.mapInArrow(partial(_emit_contexts, wanted=wanted), "term string, context long")
        met = met.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_t"), F.count("context").alias("_known"))
        # no pair of a term over its number reaches the threshold
        counts = counts.unionByName(met.where("n_t = _known").select("term", "n_t"))
    share = F.when(F.col("ic") > 0, 1 + F.log(F.col("n_te") / F.greatest("n_t", "n_te")) / F.col("ic"))
    # an entity that is all there is carries no information; a term that is never elsewhere discloses it all the same
    share = F.coalesce(share, (F.col("n_t") <= F.col("n_te")).cast("double"))
    return pairs.join(counts, "term").select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= threshold)


# ---- marking ---------------------------------------------------------------

def _terms_of_texts(rows: DataFrame, disclosing: DataFrame, chars) -> DataFrame:
    """k1, k2 (a text's key) and the terms that its own entities give away; only texts that have any.

    Terms that disclose a value stand as they are, those that disclose a kind after it and a bar. The mentions
    are joined with the disclosing pairs, so the texts themselves do not move.
    """

    def entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            out = set()
            for text, a, b in zip(strings(batch), column(batch, "k1").to_pylist(), column(batch, "k2").to_pylist()):
                for span, matches, near in _around(text, chars.value):
                    if span[0] != "literal":
                        out.add((a, b, entity_of(text, span), None))
                    else:
                        out.update((a, b, KIND + "literal", matches[i][0].lower()) for i in near)
            k1, k2, entity, near_term = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_pydict(
                {"k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "entity": pa.array(entity, pa.string()), "near": pa.array(near_term, pa.string())}
            )

    mentions = rows.where(F.col("text").rlike("@|[0-9]")).select("text", *text_key())
    mentions = pin(mentions.mapInArrow(entities, "k1 long, k2 long, entity string, near string").distinct(), "text-mentions")
    of_value = mentions.where("near IS NULL").join(disclosing.where(~F.col("entity").startswith(KIND)), "entity")
    kinds = disclosing.where(F.col("entity").startswith(KIND)).select("entity", F.col("term").alias("near"), F.lit(True).alias("known"))
    of_kind = lookup_join(mentions.where("near IS NOT NULL"), kinds, ["entity", "near"], ["known"]).where("known")
    of_kind = of_kind.select("k1", "k2", F.concat(F.substring("entity", len(KIND) + 1, 100), F.lit("|"), "near").alias("term"))
    both = of_value.select("k1", "k2", "term").unionByName(of_kind)
    return both.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def all_spans(text: str, terms: list[str] | None, chars: Characters | None = None) -> list[Span]:
    """Base spans, then secrets, then term spans that touch none of them."""
    spans = base_spans(text)
    if not terms:
        return spans
    values, kinds = {t for t in terms if "|" not in t}, {t for t in terms if "|" in t}
    found: dict[int, int] = {m.start(): m.end() for m in _TERM.finditer(text) if m[0].lower() in values} if values else {}
    if kinds and chars:
        for (kind, a, b), matches, near in _around(text, chars):
            if kind == "literal" and any(f"literal|{matches[i][0].lower()}" in kinds for i in near):
                spans.append(("secret", a, b))
    covered = sorted((a, b) for _, a, b in spans)
    starts, ends = [a for a, _ in covered], list(accumulate((b for _, b in covered), max))
    for a, b in sorted(found.items()):
        i = bisect_left(starts, b)
        if not i or ends[i - 1] <= a:
            spans.append(("term", a, b))
    return spans


def sanitise(text: str, spans: list[Span]) -> str:
    """Base spans become their kind in brackets, disclosing terms go; of overlapping spans the first stands for all."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], "" if kind == "term" else f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _with_terms(docs: DataFrame) -> tuple[DataFrame, str, object]:
    """``docs`` with the disclosing terms of each text, under a new name, and the sent character model."""
    rows = texts(docs).select("text")
    chars = characters(rows)
    sent = docs.sparkSession.sparkContext.broadcast(chars)
    disclosing = pin(disclosing_terms(docs, chars=chars), "disclosing")
    terms = pin(_terms_of_texts(rows, disclosing, sent), "text-terms")
    name = fresh(docs, "_pii_terms")
    one = [F.coalesce(docs["text"], F.lit(""))]
    keys = {fresh(docs, "_pii_k1"): F.xxhash64(*one), fresh(docs, "_pii_k2"): F.xxhash64(F.lit(7919), *one)}
    table = terms.select(*[F.col(a).alias(b) for a, b in zip(["k1", "k2"], keys)], F.col("terms").alias(name))
    joined = lookup_join(docs.withColumns(keys), table, list(keys), [name])
    return joined.select(*docs.columns, name), name, sent


def spans_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans as kind:start:end, and the number of secrets and of all spans."""
    rows, name, chars = _with_terms(docs.select("doc_id", "text"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_secret long, n_spans long"
    types = [pa.int64() if " long" in f else pa.string() for f in schema.split(", ")]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        say = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        for batch in portions(batches):
            out = []
            for doc_id, text, terms in zip(column(batch, "doc_id").to_pylist(), strings(batch), column(batch, name).to_pylist()):
                spans = all_spans(text, terms, chars.value)
                base = [s for s in spans if s[0] in KINDS]
                n = Counter(s[0] for s in spans)
                digest = hashlib.sha256(say(base).encode()).hexdigest()
                out.append((doc_id, *[n[k] for k in KINDS], digest, say(spans), n["secret"], len(spans)))
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, schema)


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data taken out of ``text``; a null text stays null, all other columns as they are."""
    rows, name, chars = _with_terms(docs)

    @F.pandas_udf("string")
    def clean(text: pd.Series, terms: pd.Series) -> pd.Series:
        found = [None if t is None else sanitise(t, all_spans(t, list(w) if w is not None else None, chars.value)) for t, w in zip(text, terms)]
        return pd.Series(found, dtype=object)

    return rows.withColumn("text", clean("text", name)).select(*docs.columns)
