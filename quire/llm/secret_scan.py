"""Secrets in texts: fixed patterns, and character Markov models of random strings (operator 5).

Base kinds are three patterns (password-like assignments, access keys, long hex runs). The method adds spans of the
kind ``markov``: stretches of runs of identifier characters that a first-order Markov model of random strings explains
better than one of ordinary identifiers, by a log-likelihood ratio of ``MIN_LLR`` or more. A run (``MIN_RUN`` characters
at least) may hold ordinary text as well, so its best-scoring stretches count, not its total; they grow to the next
separators (``/``, ``_``, ``=``, ``-``) and have ``MIN_RUN`` characters or more. What base spans cover is cut out of them.

Both models are trained from labelled samples, as transition counts of neighbouring characters. Ordinary: runs of
identifier characters outside base matches, in all documents. Random: the values of the base matches in all documents,
and ``DIGESTS`` made digests in hex, base 64 and upper case. Runs are counted before their characters are (words repeat),
so a run met a billion times is taken apart once. No kind of base match weighs more than the digests together, so a
corpus full of one kind of key does not teach that randomness looks like that. A model has one number per pair of ASCII
characters, smoothed by a uniform prior.

Everything is DataFrame expressions. A text is scanned where it is read, without any shuffle. Spark gives matches but
not where they are, so positions are running sums over the lengths of the matches and of the gaps between them
(``split`` by the same pattern). The sums run in blocks of ``CHUNK`` matches, so that a text with very many matches
costs little more than its length.

Cases: a null or empty text has no spans; repeated rows give repeated rows; an empty table gives no rows (its models
are flat); positions are code points, ends exclusive; extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import let

# Fixed values of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more: a shorter run has no longer match inside
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6
KINDS = ("assign", "access", "hex", "markov")

DIGESTS = 32_000
MIN_RUN = 16
MIN_LLR = 12.0
RUN = r"[A-Za-z0-9+/_=-]"
SEPARATOR = "/_=-"
PARTS = "array<struct<start:int,end:int>>"
ALPHABET = 128
PRIOR = 16
CHUNK = 512


def _spans(text: Column, pattern: str, kind: int, keep=None, group: int = 0, parts=None) -> Column:
    """``array<struct<start, kind, end>>`` of the matches of ``pattern`` for which ``keep(group of the match)`` holds.

    With ``parts``, of the parts ``(start, end)`` that it gives of every match.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if parts is not None:
        lengths = F.transform(whole, lambda m: F.struct(F.length(m).alias("n"), parts(m).alias("keep")))
    elif keep is None:
        lengths = F.transform(whole, lambda m: F.struct(F.length(m).alias("n"), F.lit(True).alias("keep")))
    elif group == 0:
        lengths = F.transform(whole, lambda m: F.struct(F.length(m).alias("n"), keep(m).alias("keep")))
    else:
        lengths = F.zip_with(whole, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
                             lambda m, g: F.struct(F.length(m).alias("n"), keep(g).alias("keep")))
    gaps = F.split(text, pattern, -1)
    items = F.zip_with(lengths, gaps, lambda m, gap: F.struct(F.length(gap).alias("gap"), m.n.alias("n"), m.keep.alias("keep")))
    found = let(items, lambda x: _positions(F.slice(x, 1, F.size(x) - 1), kind, parts is not None))  # the last gap follows no match
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def _positions(items: Column, kind: int, parts: bool = False) -> Column:
    """Spans of the kept items (or of their kept parts) from ``(gap, n, keep)``: sums over blocks first, then inside every block."""

    def block(i: Column) -> Column:
        return F.slice(items, i * CHUNK + 1, CHUNK)

    def total(i: Column) -> Column:
        return F.aggregate(block(i), F.lit(0), lambda acc, x: acc + x.gap + x.n)

    def inside(at: Column, i: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc.at + x.gap
            if parts:
                shifted = F.transform(x.keep, lambda p: F.struct((start + p.start).alias("start"), F.lit(kind).alias("kind"), (start + p.end).alias("end")))
                return F.struct((start + x.n).alias("at"), F.concat(acc.out, shifted).alias("out"))
            span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x.n).alias("end")))
            return F.struct((start + x.n).alias("at"), F.when(x.keep, F.concat(acc.out, span)).otherwise(acc.out).alias("out"))

        zero = F.struct(at.alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))
        return F.aggregate(block(i), zero, step, lambda acc: acc.out)

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))
    ahead = F.aggregate(
        F.transform(blocks, total), F.array(F.lit(0)),
        lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    return F.when(F.size(items) > 0, F.flatten(F.zip_with(blocks, F.slice(ahead, 1, F.size(blocks)), lambda i, at: inside(at, i)))).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def _codes(run: Column) -> Column:
    return F.transform(F.split(run, ""), lambda c: F.ascii(c))


def _ratios(run: Column, table: Column) -> Column:
    """The log ratios of a run's transitions, in order."""
    return let(_codes(run), lambda x: F.zip_with(
        F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.coalesce(F.get(table, a * ALPHABET + b), F.lit(0.0))))


def _best(ratios: Column, least: float) -> Column:
    """``array<struct<start, end>>`` of the characters of all stretches whose sum is ``least`` or more.

    One scan: a stretch starts over where its sum falls to 0, and ends at its highest sum where it falls by ``least`` below that.
    """

    def found(acc: Column) -> Column:
        part = F.array(F.struct(acc.start.alias("start"), acc.end.alias("end")))
        return F.when(acc.best >= least, F.concat(acc.out, part)).otherwise(acc.out)

    def step(acc: Column, v: Column) -> Column:
        at, total = acc.at + 1, acc.sum + v
        over, higher = (total <= 0) | (total < acc.best - least), total > acc.best
        return F.struct(
            at.alias("at"), F.when(over, 0.0).otherwise(total).alias("sum"), F.when(over, at).otherwise(acc.start).alias("start"),
            F.when(over, 0.0).when(higher, total).otherwise(acc.best).alias("best"),
            F.when(higher & ~over, at + 1).otherwise(acc.end).alias("end"), F.when(over, found(acc)).otherwise(acc.out).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"), F.lit(0).alias("start"), F.lit(0.0).alias("best"), F.lit(0).alias("end"), F.array().cast(PARTS).alias("out"))
    return F.aggregate(ratios, zero, step, found)


def _grown(run: Column, part: Column) -> Column:
    """A part of a run without separators ahead, grown to the separators around it."""
    own = F.substring(run, part.start + 1, part.end - part.start)
    lead = F.length(F.regexp_extract(own, f"^[{SEPARATOR}]+", 0))
    back = F.length(F.regexp_extract(F.reverse(F.substring(run, F.lit(1), part.start)), f"^[^{SEPARATOR}]*", 0))
    on = F.length(F.regexp_extract(F.substring(run, part.end + 1, F.length(run)), f"^[^{SEPARATOR}]*", 0))
    closed = F.substring(run, part.end, F.lit(1)).rlike(f"[{SEPARATOR}]")
    return F.struct((part.start + F.when(lead > 0, lead).otherwise(-back)).alias("start"), (part.end + F.when(closed, 0).otherwise(on)).alias("end"))


def stretches(run: Column, table: Column, least: float) -> Column:
    """``array<struct<start, end>>``: the random parts of a run, apart from each other."""

    def merged(acc: Column, p: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        longer = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.least(last.start, p.start).alias("start"), F.greatest(last.end, p.end).alias("end"))))
        return F.when((F.size(acc) > 0) & (p.start < last.end), longer).otherwise(F.concat(acc, F.array(p)))

    grown = F.transform(_best(_ratios(run, table), least), lambda p: _grown(run, p))
    return F.filter(F.aggregate(grown, F.array().cast(PARTS), merged), lambda p: p.end - p.start >= MIN_RUN)


def _without(span: Column, others: Column) -> Column:
    """What sorted spans leave of ``span``."""

    def piece(start: Column, end: Column) -> Column:
        return F.array(F.struct(start.alias("start"), span.kind.alias("kind"), end.alias("end")))

    def step(acc: Column, b: Column) -> Column:
        return F.struct(F.greatest(acc.at, b.end).alias("at"), F.when(b.start > acc.at, F.concat(acc.out, piece(acc.at, b.start))).otherwise(acc.out).alias("out"))

    zero = F.struct(span.start.alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))
    near = F.filter(others, lambda b: (b.start < span.end) & (span.start < b.end))
    return F.aggregate(near, zero, step, lambda acc: F.when(acc.at < span.end, F.concat(acc.out, piece(acc.at, span.end))).otherwise(acc.out))


def training_sample(docs: DataFrame, digests: int = DIGESTS) -> DataFrame:
    """``(kind, run, n)``: labelled runs and how often they occur. Kind -1 is ordinary, a base kind its secrets, and the
    kind after the last base kind the made digests."""
    base = "|".join(f"(?:{p})" for p in (ASSIGN, ACCESS, HEX))
    marked = F.col("text").rlike(base)
    rest = F.when(marked, F.regexp_replace("text", base, " ")).otherwise(F.col("text"))

    def runs(kind: int, found: Column) -> Column:
        return F.transform(found, lambda r: F.struct(F.lit(kind).alias("kind"), r.alias("run")))

    values = F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= MIN_VALUE)
    secrets = F.concat(runs(0, values), *[runs(i, F.regexp_extract_all("text", F.lit(p), F.lit(0))) for i, p in ((1, ACCESS), (2, HEX))])
    ordinary = runs(-1, F.regexp_extract_all(rest, F.lit(RUN + "{6,}"), F.lit(0)))
    met = docs.select(F.inline(F.when(marked, F.concat(ordinary, secrets)).otherwise(ordinary)))

    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    dense = F.translate(F.base64(F.unhex(digest)), "=\r\n", "")
    made = docs.sparkSession.range(digests).select(
        F.lit(len(KINDS)).alias("kind"), F.explode(F.array(digest, dense, F.translate(F.upper(dense), "+/", ""))).alias("run"))
    return met.groupBy("kind", "run").agg(F.count(F.lit(1)).alias("n")).unionAll(made.select("kind", "run", F.lit(1).cast("long").alias("n")))


def train(sample: DataFrame) -> list[float]:
    """Log ratios of all transitions, indexed by ``first * ALPHABET + second``, from labelled runs."""
    pairs = let(_codes(F.col("run")), lambda x: F.zip_with(
        F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    counts = (
        sample.select("kind", "n", F.inline(pairs))
        .where((F.col("a") < ALPHABET) & (F.col("b") < ALPHABET) & (F.col("a") > 0) & (F.col("b") > 0))
        .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect())  # at most five rows per pair of ASCII characters
    of_kind: dict[int, float] = {}
    for r in counts:
        of_kind[r["kind"]] = of_kind.get(r["kind"], 0) + r["n"]
    made = of_kind.get(len(KINDS), 0)
    weigh = {k: 1.0 if k < 0 else min(1.0, made / size) for k, size in of_kind.items()}
    size = {label: sum(of_kind[k] * weigh[k] for k in of_kind if (k >= 0) == label) for label in (True, False)}
    least = min(size.values())
    models = []
    for label in (True, False):  # scaled to the smaller sample, so that what neither has seen speaks for neither
        n: dict[tuple[int, int], float] = {}
        first = [0.0] * ALPHABET
        for r in sorted(counts, key=lambda r: (r["kind"], r["a"], r["b"])):
            if (r["kind"] >= 0) == label:
                k = r["n"] * weigh[r["kind"]] * least / size[label]
                n[r["a"], r["b"]] = n.get((r["a"], r["b"]), 0.0) + k
                first[r["a"]] += k
        models.append([math.log((n.get((a, b), 0) + PRIOR / ALPHABET) / (first[a] + PRIOR)) for a in range(ALPHABET) for b in range(ALPHABET)])
    return [round(x - y, 6) for x, y in zip(*models, strict=True)]


def with_spans(docs: DataFrame, ratios: list[float], min_llr: float = MIN_LLR) -> DataFrame:
    """``docs`` (with a column ``text``) and the arrays ``base`` and ``extra`` of spans ``(start, kind, end)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    base = F.array_sort(F.concat(
        _spans(text, ASSIGN, 0, lambda v: F.length(v) >= MIN_VALUE, 2), _spans(text, ACCESS, 1), _spans(text, HEX, 2)))
    extra = _spans(text, RUN + "{%d,}" % MIN_RUN, 3, parts=lambda run: stretches(run, table, min_llr))
    found = docs.withColumn("base", base).withColumn("extra", extra)
    return found.withColumn("extra", F.flatten(F.transform("extra", lambda s: _without(s, F.col("base")))))


def _said(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))))


def secret_scan(docs: DataFrame, ratios: list[float] | None = None, min_llr: float = MIN_LLR) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov)`` of every row of ``docs``.

    ``ratios`` are those of ``train``; without them they are learned from ``docs``.
    """
    found = with_spans(docs.select("doc_id", "text"), ratios or train(training_sample(docs)), min_llr).drop("text")
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{KINDS[i]}") for i in range(3)], F.sha2(_said(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _said(F.array_sort(F.concat("base", "extra"))).alias("spans"), F.size("extra").cast("long").alias("n_markov"))


def redacted(docs: DataFrame, marker: str = "[SECRET]", ratios: list[float] | None = None, min_llr: float = MIN_LLR) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``marker`` (touching spans by one), and ``n_chars`` to match."""
    found = with_spans(docs.select(F.struct(*docs.columns).alias("row"), F.col("text")), ratios or train(training_sample(docs)), min_llr)
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc.at + 1, s.start - acc.at)
        new = F.struct(F.concat(acc.out, gap, F.lit(marker)).alias("out"), s.end.alias("at"))
        longer = F.struct(acc.out.alias("out"), F.greatest(acc.at, s.end).alias("at"))
        return F.when(s.start >= acc.at, new).otherwise(longer)

    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    spans = F.array_sort(F.concat("base", "extra"))
    clean = F.aggregate(spans, zero, step, lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))))
    out = found.select("row", F.when(F.size("base") + F.size("extra") > 0, clean).otherwise(text).alias("text"))
    same = F.col("text").eqNullSafe(F.col("row.text"))
    return out.select(*[
        F.col("text") if c == "text" else F.when(same, F.col("row.n_chars")).otherwise(F.length("text")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row")[c].alias(c)
        for c in docs.columns])
