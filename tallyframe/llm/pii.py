"""Personal data by fixed forms, and by bootstrapped contexts (native).

The fixed forms (email, IP address, card, phone) are the seeds. The words right before and
after an entity are lexical patterns. Patterns and instances form a graph that is scored in
rounds: a pattern is as good as the share of its word's occurrences in the whole corpus that
stand next to an accepted instance, an instance as likely as its patterns together say.
Candidates are what no form covers of tokens with digits, ``@`` or ``::``, runs of numbers
joined by single blanks, and addresses with a spelt ``at``. They are accepted above a
threshold and then support further patterns, until nothing is added. Words of letters alone
are no candidates.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import whole_text
from tallyframe.plans.joins import fits_broadcast
from tallyframe.plans.staging import stage

KINDS = ("email", "ip", "card", "phone")
CANDIDATE = len(KINDS)
# Characters of a text that are looked at together for the neighbouring words, and entries that
# are summed together.
PIECE = 256
CHUNK = 256
MIN_SUPPORT = 5  # distinct accepted values a pattern must have stood next to
MIN_CONFIDENCE = 0.5
ACCEPT = 0.8

# Stand for a separator between two digits, and for a dot between two letters of a host,
# in a copy of the text. Single characters, so places stay; the same characters in the text
# itself become others that are in no form.
_SEP, _DOT, _OTHER = "\ue000", "\ue001", "\ue002"
_WS = r"\x20\x09-\x0D"
_LOCAL = rf"[A-Za-z0-9._%+\-{_DOT}]"
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: inside a lambda it would be for each entry."""
    return F.transform(F.array(value), body)[0]


def _running(lengths: Column) -> Column:
    """The sums up to and with each entry, in chunks, as each step copies what it has so far."""
    none = F.array().cast("array<int>")

    def add(acc: Column, length: Column) -> Column:
        total = acc["at"] + length
        return F.struct(total.alias("at"), F.array_append(acc["sums"], total).alias("sums"))

    def add_chunk(acc: Column, chunk: Column) -> Column:
        return _with(
            F.aggregate(chunk, F.struct(acc["at"].alias("at"), none.alias("sums")), add),
            lambda inner: F.struct(inner["at"].alias("at"), F.concat(acc["sums"], inner["sums"]).alias("sums")))

    def summed(lengths: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int")),
            lambda i: F.slice(lengths, i * CHUNK + 1, CHUNK))
        return F.when(F.size(lengths) > 0, F.aggregate(
            chunks, F.struct(F.lit(0).alias("at"), none.alias("sums")), add_chunk, lambda acc: acc["sums"])).otherwise(none)

    return _with(lengths, summed)


def _spans(text: Column, form: str, kind: int) -> Column:
    """All matches from left to right: what lies between them gives their places."""
    def placed(found: Column, between: Column) -> Column:
        ends = _running(F.transform(found, lambda value, i: F.char_length(F.get(between, i)) + F.char_length(value)))
        return F.transform(F.arrays_zip(found.alias("value"), ends.alias("end")), lambda s: F.struct(
            (s["end"] - F.char_length(s["value"])).alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"),
            s["value"].alias("value")))

    both = F.struct(F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("found"),
                    F.split(text, form, -1).alias("between"))
    return _with(both, lambda b: placed(b["found"], b["between"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum holds, every second digit from the right doubled."""
    def doubled(d: Column) -> Column:
        return F.when(d > 4, 2 * d - 9).otherwise(2 * d)

    places = F.sequence(F.lit(1), F.char_length(digits))
    total = F.aggregate(
        places, F.lit(0),
        lambda acc, i: acc + F.when(
            (F.char_length(digits) - i) % 2 == 1, doubled(F.substring(digits, i, F.lit(1)).cast("int"))
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")))
    return total % 10 == 0


def _where(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the four forms, sorted by start, then kind.

    The expressions scan a text once: a form starts only where its run of characters starts
    or the last match ended, and runs are taken whole, which finds the same matches.
    """
    dotted = F.regexp_replace(
        F.translate(text, _DOT, _OTHER), r"(?<=[A-Za-z0-9\-])\.(?=[A-Za-z0-9\-])", _DOT)
    email = _spans(
        dotted, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9\-]++{_DOT}[A-Za-z0-9\-{_DOT}]++", 0)
    ip = F.filter(
        _spans(text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 1),
        lambda s: s["value"].rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}"))
    run = F.regexp_replace(F.translate(text, _SEP, _OTHER), r"(?<=[0-9])[\x20\-](?=[0-9])", _SEP)
    card = F.filter(
        _spans(run, rf"[0-9][0-9{_SEP}]++", 2),
        lambda s: F.when(F.char_length(_digits(s["value"])).between(14, 19), _luhn(_digits(s["value"])))
        .otherwise(False))
    phone = F.filter(
        _spans(text, r"\+[0-9][\x20().0-9\-]+[0-9]", 3),
        lambda s: F.char_length(_digits(s["value"])).between(10, 15))
    return F.array_sort(F.concat(
        _where(F.contains(text, F.lit("@")), email),
        _where(text.rlike(r"[0-9]\.[0-9]"), ip),
        _where(text.rlike(r"[0-9](?:[\x20\-]?[0-9]){13}"), card),
        _where(text.rlike(r"\+[0-9]"), phone)))


# A number that ends its token, a run of such with one blank between, and other tokens.
_NUMBER_NEXT = rf"(?=\(?[0-9][0-9()./\-]*+[^0-9A-Za-z{_WS}]*+(?:[{_WS}]|\z))"
_RUN = rf"(?:[^{_WS}0-9]*+[0-9][0-9()./\-]*+\x20{_NUMBER_NEXT})*+[^{_WS}0-9]*+[0-9][^{_WS}]*+"
_BRACKETED = r"\x20?[(\[{{]\x20?(?i:{})\x20?[)\]}}]\x20?"
_NAME = r"[A-Za-z0-9\-]++"
_SPELT = (rf"[A-Za-z0-9._%+\-]++(?:{_BRACKETED.format('at')}{_NAME}(?:(?:{_BRACKETED.format('dot')}|\x20dot\x20|\.){_NAME})*+"
          rf"|\x20at\x20{_NAME}(?:(?:{_BRACKETED.format('dot')}|\x20dot\x20|\.){_NAME})++)")
_SHAPES = rf"(?<![^{_WS}])(?:{_SPELT}|{_RUN}|(?=[^{_WS}]*(?:@|::))[^{_WS}]++)"
# What stands before an identifier in its token: marks, and a name before ``=`` or ``:``.
_LEAD = (rf"^(?:(?!::|\([0-9]+\)\x20?[0-9])[^0-9A-Za-z+@])*"
         rf"(?:(?![^{_WS}]*::)[A-Za-z_\-]+[=:][\"']*)?")


def _candidates(text: Column) -> Column:
    """Tokens and runs of them, without marks at their ends and a name before ``=`` or ``:``."""
    token = _spans(text, _SHAPES, CANDIDATE)

    def core(s: Column) -> Column:
        lead = F.char_length(F.regexp_extract(s["value"], _LEAD, 0))
        tail = F.char_length(F.regexp_extract(F.substring(s["value"], lead + 1, F.char_length(s["value"])), r"[^0-9A-Za-z]*$", 0))
        return F.struct(
            (s["start"] + lead).alias("start"), s["kind"].alias("kind"), (s["end"] - tail).alias("end"),
            F.substring(s["value"], lead + 1, F.char_length(s["value"]) - lead - tail).alias("value"))

    return _where(text.rlike(r"[0-9@]|::|(?i:\bat\b)"), F.filter(
        F.transform(token, core), lambda s: s["start"] < s["end"]))


def _with_context(text: Column, spans: Column) -> Column:
    """Add the word before and the word after, in lower case; a name with ``=`` counts as a word.

    Words are sought in the pieces of the text around a span, so that no span walks the text
    from its start; only where these do not hold the whole word it is sought in all the text.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    last, first = rf"([^{_WS}]+)[{_WS}]*$", rf"^[^{_WS}]*[{_WS}]+([^{_WS}]+)"

    def words(pieces: Column, s: Column) -> Column:
        at, to = F.floor(s["start"] / PIECE).cast("int"), F.floor(s["end"] / PIECE).cast("int")
        here = F.concat(F.coalesce(F.get(pieces, at - 1), F.lit("")), F.substring(
            F.coalesce(F.get(pieces, at), F.lit("")), F.lit(1), s["start"] % PIECE))
        # A word that begins behind a blank, or with the text, is whole.
        left = F.when((at > 1) & ~here.rlike(rf"[{_WS}][^{_WS}]+[{_WS}]*$"), F.regexp_extract(
            F.substring(text, F.lit(1), s["start"]), last, 1)).otherwise(F.regexp_extract(here, last, 1))
        ahead = F.concat(F.substring(F.coalesce(F.get(pieces, to), F.lit("")), s["end"] % PIECE + 1, F.lit(PIECE)),
                         F.coalesce(F.get(pieces, to + 1), F.lit("")))
        rest = F.size(pieces) > to + 2
        right = F.when(rest & ~ahead.rlike(rf"^[^{_WS}]*[{_WS}]+[^{_WS}]+[{_WS}]"), F.regexp_extract(
            F.substring(text, s["end"] + 1, F.char_length(text)), first, 1)).otherwise(F.regexp_extract(ahead, first, 1))
        return F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
            F.lower(left).alias("left"), F.lower(right).alias("right"))

    both = F.struct(pieces.alias("pieces"), spans.alias("spans"))
    return _with(both, lambda b: F.transform(b["spans"], lambda s: words(b["pieces"], s)))


def find_pii(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", rounds: int | None = None,
             min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
             accept: float = ACCEPT) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``added``, arrays of ``(start, kind, end)``.

    Places are code points, the end exclusive; ``kind`` numbers ``KINDS``. ``base`` is sorted
    and never changed by what the contexts add, which does not overlap it. A null or empty
    text has no spans. Identifiers may be null or repeat; rows are told apart by their stored
    number. An empty table gives no rows. Rounds go on until no span is added, at most
    ``rounds`` where that is given.
    """
    read = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    # One stored row per document without its text: the graph is built from these.
    based = read.select("*", base_spans(F.col("text")).alias("spans"))
    free = F.filter(
        _candidates(F.col("text")),
        lambda c: ~F.exists("spans", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    found = stage(
        based.select(
            "key", "doc_id", F.size("spans").alias("n_base"),
            _with_context(F.col("text"), F.concat("spans", free)).alias("all")),
        "found")
    base = F.transform(
        F.slice("all", 1, F.col("n_base")),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    instances = found.filter(F.size("all") > 0).select("key", F.explode("all").alias("s")).select("key", "s.*")
    side = F.explode(F.array(
        F.struct(F.lit("L").alias("side"), F.col("left").alias("word")),
        F.struct(F.lit("R").alias("side"), F.col("right").alias("word"))))
    graph = (
        instances.select("key", "start", "end", "kind", "value", side.alias("p"))
        .select("key", "start", "end", "kind", "value", "p.side", "p.word").filter("word != ''")
    )
    # Patterns that can reach the support at all; the rest of the graph is not followed.
    able = (
        graph.groupBy("side", "word")
        .agg(F.count("*").alias("near"), F.count_distinct("value").alias("values"))
        .filter(F.col("values") >= min_support).drop("values")
    )
    able = stage(able, "patterns")
    totals = _occurrences(read, able.select("word").distinct())
    able = stage(
        able.join(totals, "word", "left")
        .withColumn("total", F.greatest("near", F.coalesce("n", F.lit(0)))).drop("n", "near"),
        "patterns")
    graph = stage(graph.join(able, ["side", "word"]), "graph")

    no_rows = graph.filter("false").select("key", "start", "end", "kind")
    accepted = no_rows
    known = -1
    for _ in count() if rounds is None else range(rounds):
        scored = (
            graph.join(accepted.select("key", "start", F.col("kind").alias("_kind")), ["key", "start"], "left")
            .withColumn("label", F.when(F.col("kind") < CANDIDATE, F.col("kind")).otherwise(F.col("_kind")))
        )
        patterns = (
            scored.filter("label is not null").groupBy("side", "word", "label")
            .agg(F.count("*").alias("hits"), F.count_distinct("value").alias("values"),
                 F.first("total").alias("total"))
            .filter(F.col("values") >= min_support)
            .withColumn("confidence", F.col("hits") / F.col("total"))
            .filter(F.col("confidence") >= min_confidence)
        )
        best = F.max(F.struct("confidence", "label"))
        accepted = stage(
            graph.filter(F.col("kind") == CANDIDATE).join(patterns.select("side", "word", "label", "confidence"), ["side", "word"])
            .groupBy("key", "start", "end")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score"), best.alias("best"))
            .filter(F.col("score") >= accept)
            .select("key", "start", "end", F.col("best.label").alias("kind")),
            "accepted")
        size = accepted.count()
        if size <= max(known, 0):
            break
        known = size

    added = accepted.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added"))
    result = found.select("key", "doc_id", base.alias("base")).join(added, "key", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return result.select("doc_id", "base", F.coalesce("added", none).alias("added"))


def _occurrences(read: DataFrame, words: DataFrame) -> DataFrame:
    """How often each of the words occurs in all texts."""
    wanted = stage(words, "words")
    said = read.select(F.explode(F.split(F.lower("text"), f"[{_WS}]+")).alias("word"))
    if fits_broadcast(wanted):
        return said.join(F.broadcast(wanted), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    counts = said.groupBy("word").agg(F.count("*").alias("n"))
    return counts.join(wanted, "word", "left_semi")


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
