"""Personal data, and the words of its documents that give it away.

Base spans (email, ip, card, phone) come from patterns. Then the corpus says how
strongly a word (a run of letters and digits) reveals a protected value: over all
texts, ``c`` documents hold both, wherever they stand, and ``df`` documents hold the
word at all, so the word leaves ``-log2(c / df)`` bits of doubt about the value. A word
is a disclosing term of a value if ``MIN_SUPPORT`` documents or more hold both, it leaves
``MAX_DOUBT_BITS`` or fewer bits of doubt, and tells ``MIN_GAIN_BITS`` or more beyond
the value's own frequency (pointwise mutual information).

A value in a share ``p`` of the documents has just ``-log2(p)`` bits to tell, for a frequent one
fewer than ``MIN_GAIN_BITS``. So a term also discloses if it tells ``MIN_SHARE`` or more of
the value's own bits, whatever they are, and is no chance find: ``df`` documents drawn at
random hold the value ``c`` times or more with probability ``2 ** -MIN_EVIDENCE_BITS`` at
most (Chernoff's bound, ``df`` times the divergence of ``c / df`` from ``p``). A value in all
documents has no bits, and no term discloses it.

In the documents that hold the value, every place of such a term outside base spans gets
a span of kind ``term``; sanitising generalises base spans to their kind and removes terms.

Counts cover all documents. They are made by combining aggregates and joined by
value and word; neither values nor words are collected. Pairs that can't count aren't made:
values in fewer than ``MIN_SUPPORT`` documents have no terms; values that the same documents
hold (an address list and its copies) have the same terms, and one stands for all; and a word in
more than ``2 ** MAX_DOUBT_BITS`` times the value's documents leaves too much doubt.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import stored, text_slices

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
MIN_SUPPORT = 3
MAX_DOUBT_BITS = 1.0
MIN_GAIN_BITS = 4.0
MIN_SHARE = 0.8
MIN_EVIDENCE_BITS = 24.0
COUNTED_WORDS = 200_000
WORDS_A_BATCH = 50_000

# The patterns' parts.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9][0-9.]{6,}")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
WORD = re.compile(r"[^\W_]+")

SPAN = "kind string, start int, stop int"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; the part before each ``@`` reaches back to the last match at most."""
    out, end = [], 0
    if "@" not in text:
        return out
    for m in EMAIL_DOMAIN.finditer(text):
        at = start = m.start()
        while start > end and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        if start < at:
            out.append((start, m.end()))
            end = m.end()
    return out


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for run in DOTTED.finditer(text) if run[0].count(".") >= 3
            for m in IP.finditer(text, run.start(), run.end())
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15]


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, stop) by kind as listed, then start; code points, end exclusive."""
    text = text or ""
    return [(kind, s, e) for kind, find in zip(KINDS, (emails, ips, cards, phones)) for s, e in find(text)]


def values_of(text: str, spans: list[tuple[str, int, int]]) -> list[str]:
    """The distinct values of base spans, as they are compared."""
    return list(dict.fromkeys(f"{kind}:{NOT_DIGIT.sub('', text[s:e]) if kind in ('card', 'phone') else text[s:e].lower()}"
                              for kind, s, e in spans))


def words_of(text: str) -> set[str]:
    return {w.lower() for w in set(WORD.findall(text))}


def places(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(word, start, stop) of all words outside base spans."""
    taken = sorted((s, e) for _, s, e in spans)
    out, k, until = [], 0, 0
    for m in WORD.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            until = max(until, taken[k][1])
            k += 1
        if m.start() >= until:
            out.append((m[0].lower(), m.start(), m.end()))
    return out


def contexts(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(value, word, start, stop): each value of the text with each place of a word outside base spans."""
    return [(v, *p) for v in values_of(text, spans) for p in places(text, spans)]


_SPANS = "array<struct<kind:string,start:int,stop:int>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def _arrow_spans(rows: list[list[tuple[str, int, int]]]) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "stop"), x)) for x in r] for r in rows], _SPANS_ARROW)


def _tuples(spans: list[dict]) -> list[tuple[str, int, int]]:
    return [(x["kind"], x["start"], x["stop"]) for x in spans]


def found(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with base spans and their distinct values (``__base``, ``__values``)."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            texts = b.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            values = [values_of(t, s) if s else [] for t, s in zip(texts, base)]
            yield pa.RecordBatch.from_arrays([*b.columns, _arrow_spans(base), pa.array(values, pa.list_(pa.string()))],
                                             [*names, "__base", "__values"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields),
                        f"__base {_SPANS}", "__values array<string>"])
    return docs.mapInArrow(run, schema)


def document_frequency(docs: DataFrame) -> DataFrame:
    """``word, df`` over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "df"])
            seen.clear()
            return rows

        for b in text_slices(batches):
            for text in b.column("text").to_pylist():
                seen.update(words_of(text or ""))
            if len(seen) > COUNTED_WORDS:
                yield out()
        yield out()

    return (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, df long")
            .groupBy("word").agg(F.sum("df").alias("df")))


def text_words(held: DataFrame) -> DataFrame:
    """``rid, most, word``: each word outside base spans of the row's text, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            for rid, most, text, base in zip(*(b.column(c).to_pylist() for c in ("rid", "most", "text", "base"))):
                near = list({w for w, _, _ in places(text, _tuples(base))})
                for lo in range(0, len(near), WORDS_A_BATCH):
                    part = near[lo:lo + WORDS_A_BATCH]
                    yield pa.RecordBatch.from_arrays([pa.array([rid] * len(part), pa.int64()), pa.array([most] * len(part), pa.int64()), pa.array(part, pa.string())],
                                                     ["rid", "most", "word"])

    return held.select("rid", "most", "text", "base").mapInArrow(run, "rid long, most long, word string")


def shared_values(values: DataFrame) -> DataFrame:
    """``value, n_value``: values (of rows ``rid, value``) that ``MIN_SUPPORT`` texts or more hold; of those
    that the very same texts hold, the first. Sets of texts are told apart by two 64-bit hashes."""
    held = values.groupBy("value").agg(F.count(F.lit(1)).alias("n_value"), *[F.bit_xor(F.xxhash64("rid", F.lit(k))).alias(f"h{k}") for k in (1, 2)])
    return (held.filter(F.col("n_value") >= MIN_SUPPORT).groupBy("n_value", "h1", "h2").agg(F.min("value").alias("value"))
            .select("value", "n_value"))


def value_words(holding: DataFrame, docs: DataFrame) -> DataFrame:
    """``rid, value, word, df, n_value``: the pairs of a text that may count."""
    values = holding.select("rid", F.explode("__values").alias("value"))
    shared = stored(shared_values(values), "pii-values")
    own = stored(values.join(shared, "value").select(F.col("rid").alias("of_rid"), "value", "n_value"), "pii-own")
    most = own.groupBy("of_rid").agg(F.max("n_value").alias("most"))
    df = stored(document_frequency(docs).filter(F.col("df") >= MIN_SUPPORT), "pii-df")
    words = text_words(holding.join(most, F.col("rid") == F.col("of_rid")))
    room = lambda n: F.col("df") <= F.col(n) * 2.0 ** MAX_DOUBT_BITS
    rare = words.join(df, "word").filter(room("most")).select("rid", "word", "df")
    pairs = rare.join(own, F.col("rid") == F.col("of_rid")).filter(room("n_value"))
    return stored(pairs.select("rid", "value", "word", "df", "n_value"), "pii-pairs")


def marked_places(rows: DataFrame) -> DataFrame:
    """``rid, __terms``: every place of the row's ``words`` outside base spans, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            out = []
            for text, base, words in zip(*(b.column(c).to_pylist() for c in ("text", "base", "words"))):
                wanted = set(words)
                out.append([(TERM, s, e) for w, s, e in places(text, _tuples(base)) if w in wanted])
            yield pa.RecordBatch.from_arrays([b.column("rid"), _arrow_spans(out)], ["rid", "__terms"])

    return rows.select("rid", "text", "base", "words").mapInArrow(run, f"rid long, __terms {_SPANS}")


def disclosing_terms(pairs: DataFrame, n_docs: int) -> DataFrame:
    """``value, word`` of the disclosing terms among ``value_words``."""
    both = pairs.groupBy("value", "word").agg(F.count(F.lit(1)).alias("c"), F.max("df").alias("df"), F.max("n_value").alias("n_value"))
    c, rest, total = F.col("c"), F.col("df") - F.col("c"), F.lit(float(n_docs))
    doubt = -F.log2(c / F.col("df"))
    gain = F.log2(c * total / (F.col("df") * F.col("n_value")))
    bits = F.log2(total / F.col("n_value"))
    evidence = c * gain + F.when(rest > 0, rest * F.log2(rest * total / (F.col("df") * (total - F.col("n_value"))))).otherwise(0.0)
    sure = (gain >= MIN_SHARE * bits) & (evidence >= MIN_EVIDENCE_BITS)
    return both.filter((c >= MIN_SUPPORT) & (doubt <= MAX_DOUBT_BITS) & ((gain >= MIN_GAIN_BITS) | sure)).select("value", "word")


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of kind, start, stop) for every row.

    ``base`` is in the order of ``KINDS``, then start; ``spans`` holds these and the
    terms behind them. A null text counts as empty. A row that is repeated comes out as
    often, each time with the same spans; an empty table gives an empty one."""
    return _marked(docs, ["doc_id"]).select("doc_id", F.col("__base").alias("base"), F.col("__spans").alias("spans"))


def _marked(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns to keep, with ``__base`` and ``__spans``."""
    d = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])
    d = d.withColumn("text", F.col("text").cast("string"))
    lean = found(d)
    if "text" not in keep:
        lean = lean.withColumn("__text", F.when(F.size("__values") > 0, F.col("text"))).drop("text")
    base = stored(lean.withColumn("__rid", F.monotonically_increasing_id()), "pii-base")
    text = "text" if "text" in keep else "__text"
    holding = (base.filter(F.size("__values") > 0)
               .select(F.col("__rid").alias("rid"), F.col(text).alias("text"), F.col("__base").alias("base"), "__values"))
    pairs = value_words(holding, d)
    terms = stored(disclosing_terms(pairs, base.count()), "pii-terms")
    words = (pairs.join(terms, ["value", "word"], "left_semi").groupBy(F.col("rid").alias("of_rid"))
             .agg(F.collect_set("word").alias("words")))
    spans = marked_places(holding.join(words, F.col("rid") == F.col("of_rid"))).withColumnRenamed("rid", "__of_rid")
    out = base.join(spans, F.col("__rid") == F.col("__of_rid"), "left")
    return out.select(*[F.col(f"`{c}`") for c in keep], "__base",
                      F.concat("__base", F.coalesce("__terms", F.expr(f"cast(array() as {_SPANS})"))).alias("__spans"))


def joined(spans: Column) -> Column:
    """kind:start:stop, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def counted(spans: Column, kind: str) -> Column:
    """Spans of one kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def sanitise(text: str | None, spans: list) -> str | None:
    """Base spans become their kind in brackets, terms go; spans that overlap are taken as one,
    named by its first base kind."""
    if text is None or not spans:
        return text
    rank = {k: i for i, k in enumerate((*KINDS, TERM))}
    runs: list[list] = []
    for kind, s, e in sorted(((x["kind"], x["start"], x["stop"]) for x in spans), key=lambda x: (x[1], rank[x[0]])):
        if runs and s < runs[-1][2]:
            runs[-1][2] = max(runs[-1][2], e)
            runs[-1][0] = min(runs[-1][0], kind, key=rank.__getitem__)
        else:
            runs.append([kind, s, e])
    out, at = [], 0
    for kind, s, e in runs:
        out += [text[at:s], "" if kind == TERM else f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def sanitise_stage(docs: DataFrame) -> DataFrame:
    """``docs`` with sanitised texts; other columns, ``n_chars`` apart, and rows without findings as they were."""
    names, schema = docs.columns, docs.schema
    marked = _marked(docs, names).drop("__base")
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            clean = [sanitise(t, s) for t, s in zip(b.column("text").to_pylist(), b.column("__spans").to_pylist())]
            cols = [b.column(c) for c in names]
            cols[text_at] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names)

    out = marked.mapInArrow(run, schema)
    if "n_chars" in names:
        kind = schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out
