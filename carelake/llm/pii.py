"""Personal data, and the terms that reveal it (information-theoretic sanitisation). DataFrame functions only.

Base spans are patterns with checks: email, ip, card, phone. A value that
occurs is a protected entity. How strongly a term reveals an entity is
estimated from co-occurrence in the corpus, by documents over whole texts: the
information about the entity that the term leaves open is

    -log2(share) bits,

where share is the lower end (one-sided, 95 %) of Wilson's interval for the part
of the term's documents that hold the entity. A term that leaves at most
``generalise`` bits open discloses the entity, so the bar is the same for a
corpus of any size. It must rest on evidence: at least ``support`` different
texts hold both (copies of one text are one observation), and the share must
exceed the entity's share of all documents by more than chance, by Chernoff's
bound at 5 % divided by the number of pairs judged.

Disclosing terms become spans of kind "term" wherever they occur, in documents
without the entity too. They are generalised to the class of their letters,
[CAPS], [NAME] or [WORD], or removed if they leave at most ``remove`` bits open.

Entities that the same texts hold have the same figures for every term, and so
have terms that the same texts hold; pairs are formed between such classes, not
between the values and words of a document. Left out before are, without effect
on the result, entities and terms in too few texts for any share to reach the bar.

Cases: a null text counts as empty; rows that repeat an id are judged each;
matches that fail their check are dropped without another try; an empty table
gives an empty result; the patterns run without recursion on texts of any
length, and spans are put together in blocks, so the work on a text with n hits
grows with n^1.5; only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import read_table, stage

SPAN = "array<struct<kind:string,start:int,stop:int,value:string>>"
PLACE = "array<struct<start:int,stop:int,word:string,removed:boolean>>"
MARK = "array<struct<start:int,stop:int,word:string,removed:boolean,fixed:boolean>>"
TERM = r"\p{L}+"
#: One-sided 95 %.
Z = 1.645
#: Lists that the due words of a document are dealt to.
SHARES = 64
#: Numbers that may be broadcast to leave rows out before a shuffle; with more, all rows move.
MOST_KEYS = 2_000_000


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """The digits from the last on, every second one doubled."""
    back = F.reverse(_digits(m))
    at = F.sequence(F.lit(1), F.length(back))

    def term(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(at, term), F.lit(0), lambda a, b: a + b) % 10 == 0


@dataclass(frozen=True)
class Kind:
    name: str
    #: Possessive forms of the plain patterns: they match the same and don't recurse. \G lets a match begin where the last one ended.
    pattern: str
    #: A cheap test that every text with a valid match passes.
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column]


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: t.contains("@"), lambda m: F.lit(True)),
    Kind("ip", r"[0-9]++(?:\.[0-9]++){3}", lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"), lambda m: F.forall(F.split(m, r"\."), lambda p: p.cast("double") <= 255)),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), lambda m: F.length(_digits(m)).between(16, 19) & _luhn(m)),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.rlike(r"\+[0-9]"), lambda m: F.length(_digits(m)).between(8, 15)),
)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def fold(items: Column, at: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """The array ``out`` that ``step`` builds over ``items`` from a state (at, out).

    Appending copies an array, so steps are taken in blocks of a square root of their number: n^1.5 copies, not n^2.
    """

    def run(x: Column) -> Column:
        begin = lambda at: F.struct(at.alias("at"), F.array().cast(kind).alias("out"))
        width = block_width(x)

        def block(state: Column, i: Column) -> Column:
            done = F.aggregate(F.slice(x, i, width), begin(state["at"]), step)
            return bind(done, lambda d: F.struct(d["at"].alias("at"), F.concat(state["out"], d["out"]).alias("out")))

        return F.aggregate(block_starts(x), begin(at), block, lambda s: s["out"])

    return bind(items, run)


def block_width(x: Column) -> Column:
    return F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(x))).cast("int"))


def block_starts(x: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(x)), block_width(x))


def spans_of(text: Column, kind: Kind) -> Column:
    """Valid matches of one kind, by start, in code points."""
    matches, gaps = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.split(text, kind.pattern, -1)
    steps = bind(matches, lambda m: F.arrays_zip(F.slice(gaps, F.lit(1), F.size(m)).alias("gap"), m.alias("hit")))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        stop = start + F.length(x["hit"])
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), stop.alias("stop"), x["hit"].alias("value"))
        return F.struct(stop.alias("at"), F.when(kind.valid(x["hit"]), F.concat(state["out"], F.array(span).cast(SPAN))).otherwise(state["out"]).alias("out"))

    return F.when(kind.hint(text), fold(steps, F.lit(0), step, SPAN)).otherwise(F.array().cast(SPAN))


def named(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def terms_in(text: Column) -> Column:
    """Distinct terms: runs of three letters or more, in lower case."""
    return F.filter(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))), lambda t: F.length(t) >= 3)


def entities(base: Column) -> Column:
    return F.array_distinct(F.transform(base, lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))


def lower_share(part: Column, whole: Column) -> Column:
    """Lower end of Wilson's interval for part / whole."""
    p, z2 = part / whole, Z * Z
    return (p + z2 / (2 * whole) - Z * F.sqrt(p * (1 - p) / whole + z2 / (4 * whole * whole))) / (1 + z2 / whole)


def signature(doc: str, *more: Column) -> list[Column]:
    """What tells the set of texts that a group's rows come from, without collecting it: two words of 64 bits."""
    return [F.bit_xor(doc).alias("x1"), F.bit_xor(F.xxhash64(F.col(doc), F.lit("other"))).alias("x2"), F.count("*").alias("texts"), *more]


def judged_pairs(found: DataFrame, of_term: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes (entity_class, term_class, texts, together, of_entity, of_term) and the terms of the classes.

    ``found``: text and base of all rows; ``of_term``: t (hash of a term), of_term (documents).
    """
    holders = found.where(F.size("base") > 0).select(F.xxhash64("text").alias("doc"), "text", "base")
    held = holders.select("doc", F.explode(entities(F.col("base"))).alias("entity")).groupBy("entity", "doc").agg(F.count("*").alias("m"))
    held = stage(held, "pii-held")
    of_entity = held.groupBy("entity").agg(*signature("doc", F.sum("m").alias("of_entity"))).where(F.col("texts") >= support)
    entity_class = F.xxhash64("x1", "x2", "texts")
    texts_of = held.join(of_entity, "entity").select(entity_class.alias("entity_class"), "doc", "m", "of_entity").distinct()
    texts_of = stage(texts_of, "pii-entity-classes")

    docs = texts_of.select("doc").distinct()
    worded = with_key(holders, F.col("doc"), docs.select(F.col("doc").alias("k"))).select("doc", F.explode(terms_in(F.col("text"))).alias("term"))
    worded = worded.select("doc", "term", F.xxhash64("term").alias("t")).distinct().join(docs, "doc", "left_semi")
    worded = stage(worded.join(of_term.where(F.col("of_term") >= support), "t"), "pii-words")
    classes = worded.groupBy("t").agg(*signature("doc", F.first("term").alias("term"), F.first("of_term").alias("of_term"))).where(F.col("texts") >= support)
    classes = stage(classes.select("t", "term", "of_term", F.xxhash64("x1", "x2", "texts", "of_term").alias("term_class")), "pii-term-classes")
    terms_of = worded.select("t", "doc").join(classes.select("t", "term_class", "of_term"), "t").select("term_class", "doc", "of_term").distinct()
    pairs = texts_of.join(terms_of, "doc").groupBy("entity_class", "term_class", "of_entity", "of_term").agg(F.count("*").alias("texts"), F.sum("m").alias("together"))
    return stage(pairs.where(F.col("texts") >= support), "pii-pairs"), classes


def disclosing_terms(found: DataFrame, docs: DataFrame, generalise: float, remove: float, support: int) -> DataFrame:
    """term, removed, elsewhere (in documents without the entity too). ``found``: text and base; ``docs``: _text of all documents."""
    words = docs.select(F.explode(terms_in(F.col("_text"))).alias("term")).select(F.xxhash64("term").alias("t"))
    of_term = words.groupBy("t").agg(F.count("*").alias("of_term"))  # summed up before any row moves
    n = float(max(docs.count(), 1))
    bar = 2.0**-generalise
    least = max(support, math.ceil(Z * Z * bar / (1 - bar)))  # with fewer texts no share reaches the bar
    pairs, classes = judged_pairs(found, of_term, least)
    judged = pairs.count()
    part = F.least(F.lit(1.0), F.col("together") / F.col("of_term"))
    seen = F.col("texts") / part  # different texts among the term's documents, as far as known
    share, chance = lower_share(part * seen, seen), F.least(F.lit(1.0), F.col("of_entity") / F.lit(n))
    rest = F.when(part < 1, (1 - part) * F.log((1 - part) / (1 - chance))).otherwise(0.0)
    apart = F.when(part > chance, seen * (part * F.log(part / chance) + rest)).otherwise(0.0)
    bits = -F.log2(share)
    told = pairs.where((bits <= generalise) & (apart >= math.log(max(judged, 1) / 0.05)))
    told = told.groupBy("term_class").agg(F.max(bits <= remove).alias("removed"), F.max(F.col("together") < F.col("of_term")).alias("elsewhere"))
    return classes.join(told, "term_class").select("term", "removed", "elsewhere")


def with_key(rows: DataFrame, key: Column, keys: DataFrame, most: int = MOST_KEYS) -> DataFrame:
    """The rows whose key (a long) is among ``keys`` (column k), or all rows if these are too many; a join decides later."""
    keys = keys.distinct()
    if keys.limit(most + 1).count() > most:
        return rows
    return rows.withColumn("k", key).join(F.broadcast(keys), "k", "left_semi").drop("k")


def find_private(docs: DataFrame, carry: tuple[str, ...] = (), generalise: float = 1.0, remove: float = 0.25, support: int = 2) -> DataFrame:
    """A row for each row: doc_id, base and spans (arrays of kind, start, stop, value), sanitised (null where nothing
    changes) and the columns named in ``carry``."""
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_raw"), *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry) if c != "text"])
    text = F.coalesce(F.col("_raw"), F.lit(""))
    base = F.concat(*[spans_of(text, k) for k in KINDS])
    found = stage(rows.withColumn("base", base).withColumn("_row", F.monotonically_increasing_id()), "pii-base")
    found = found.withColumn("text", text)
    told = stage(disclosing_terms(found, rows.select(text.alias("_text")), generalise, remove, support), "pii-told")

    # A term that always comes with one entity is in holders only.
    due_in = lambda rows, terms: with_key(rows.select("_row", F.explode(terms_in(F.col("text"))).alias("term")), F.xxhash64("term"), terms.select(F.xxhash64("term").alias("k"))).join(terms.select("term", "removed"), "term")
    due = due_in(found.where(F.size("base") > 0), told).unionByName(due_in(found.where(F.size("base") == 0), told.where("elsewhere")))
    due = stage(due, "pii-due")
    # Places of the due terms in their documents.
    of_row = due.groupBy("_row").agg(F.collect_list("term").alias("due"), F.collect_list(F.when(F.col("removed"), F.col("term"))).alias("gone"))  # one document's
    affected = with_key(found.select("_row", "text"), F.col("_row"), due.select(F.col("_row").alias("k"))).join(of_row, "_row")
    extra = affected.select("_row", places(F.col("text"), F.col("due"), F.col("gone")).alias("extra"))

    rows = found.join(extra, "_row", "left")
    rows = rows.withColumn("free", F.when(F.size("extra") > 0, clear_of(F.col("extra"), F.col("base"))).otherwise(F.array().cast(PLACE)))
    free = F.col("free")
    added = F.transform(free, lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["word"].alias("value"))).cast(SPAN)
    marks = F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put"))),
        F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.when(s["removed"], F.lit("")).otherwise(letters_class(s["word"])).alias("put"))),
    )
    carried = [F.col("_raw" if c == "text" else f"_carry{i}").alias(c) for i, c in enumerate(carry)]
    return rows.select(F.col("_id").alias("doc_id"), *carried, "base", F.concat("base", added).alias("spans"), F.when(F.size(marks) > 0, rewritten(F.col("text"), marks)).alias("sanitised"))


def letters_class(word: Column) -> Column:
    """What a generalised term shows: whether it is written in capitals, begins with one, or neither."""
    return F.when(word.rlike(r"^\p{Lu}+$"), "[CAPS]").when(word.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")


def places(text: Column, due: Column, gone: Column) -> Column:
    """Where the words are that are due, in small letters, by start; removed: also among ``gone``."""
    steps = F.arrays_zip(F.split(text, TERM, -1).alias("gap"), F.regexp_extract_all(text, F.lit(TERM), F.lit(0)).alias("word"))
    # words are looked up in their share of the list
    share = lambda w: F.pmod(F.xxhash64(w), F.lit(SHARES)).cast("int")
    shares = lambda words: F.transform(F.sequence(F.lit(0), F.lit(SHARES - 1)), lambda i: F.filter(words, lambda w: share(w) == i))

    def run(lists: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            word = F.coalesce(x["word"], F.lit(""))
            small = F.lower(word)
            start = state["at"] + F.length(x["gap"])
            stop = start + F.length(word)
            among = lambda name: F.array_contains(F.get(lists[name], share(small)), small)
            hit = F.struct(start.alias("start"), stop.alias("stop"), word.alias("word"), among("gone").alias("removed"))
            return F.struct(stop.alias("at"), F.when(among("due"), F.concat(state["out"], F.array(hit).cast(PLACE))).otherwise(state["out"]).alias("out"))

        return fold(steps, F.lit(0), step, PLACE)

    return bind(F.struct(shares(due).alias("due"), shares(gone).alias("gone")), run)


def clear_of(own: Column, base: Column) -> Column:
    """The places among ``own`` that overlap no span of ``base``: one pass against what ended before, one back against what begins after."""
    place = lambda s, word, removed, fixed: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), word.alias("word"), removed.alias("removed"), F.lit(fixed).alias("fixed"))
    marks = F.concat(F.transform(base, lambda s: place(s, s["value"], F.lit(False), True)).cast(MARK), F.transform(own, lambda s: place(s, s["word"], s["removed"], False)).cast(MARK))

    def keep(state: Column, x: Column, at: Column, clear: Column) -> Column:
        out = F.when(x["fixed"] | clear, F.concat(state["out"], F.array(x).cast(MARK))).otherwise(state["out"])
        return F.struct(F.when(x["fixed"], at).otherwise(state["at"]).alias("at"), out.alias("out"))

    ahead = fold(F.array_sort(marks), F.lit(0), lambda s, x: keep(s, x, F.greatest(s["at"], x["stop"]), x["start"] >= s["at"]), MARK)
    back = fold(F.reverse(ahead), F.lit(2**31 - 1), lambda s, x: keep(s, x, F.least(s["at"], x["start"]), x["stop"] <= s["at"]), MARK)
    return F.transform(F.filter(F.reverse(back), lambda x: ~x["fixed"]), lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["word"].alias("word"), x["removed"].alias("removed"))).cast(PLACE)


def rewritten(text: Column, marks: Column) -> Column:
    """The text with every marked stretch replaced; of overlapping marks the first gives the replacement.

    Gaps are cut from the stretch of a block of marks, since cutting walks the text from its begin.
    """

    def run(x: Column) -> Column:
        width = block_width(x)

        def block(state: Column, i: Column) -> Column:
            own = F.slice(x, i, width)
            end = F.greatest(state["at"], F.array_max(F.transform(own, lambda m: m["stop"])))
            part = F.struct(F.substring(text, state["at"] + 1, end - state["at"]).alias("text"), state["at"].alias("begin"))

            def put(p: Column) -> Column:
                def step(s: Column, m: Column) -> Column:
                    gap = F.substring(p["text"], s["at"] - p["begin"] + 1, m["start"] - s["at"])
                    out = F.when(m["start"] >= s["at"], F.concat(s["out"], F.array(gap, m["put"]))).otherwise(s["out"])
                    return F.struct(F.greatest(s["at"], m["stop"]).alias("at"), out.alias("out"))

                return F.aggregate(own, F.struct(p["begin"].alias("at"), F.array().cast("array<string>").alias("out")), step)

            return bind(bind(part, put), lambda d: F.struct(d["at"].alias("at"), F.concat(state["out"], F.array(F.array_join(d["out"], ""))).alias("out")))

        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(block_starts(x), begin, block, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))

    return bind(F.array_sort(marks), run)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and all spans of every document."""
    found = find_private(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k.name) for k in KINDS], F.sha2(named(F.col("base")).cast("binary"), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
