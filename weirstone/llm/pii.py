"""Personal data: direct identifiers, and terms that disclose them by what they occur with.

DataFrame functions only.

Direct: emails, IPv4 addresses, card numbers (13 to 19 digits, Luhn) and phone numbers (9 to
15 digits), leftmost and without overlap per kind; a match that fails its test is dropped.

Disclosure: the words that share a sentence with an identifier are its candidate terms (of a
longer sentence the words within SENTENCE characters on both sides). Over the whole corpus of N
documents, with n(e), n(t) and n(e,t) documents that hold the identifier, the term, and both in
one sentence,

    PMI(e,t) = log(n(e,t) N / (n(e) (n(t) + 1/2)))        IC(e) = log(N / n(e))

A term gives the identifier away if PMI >= THRESHOLD * IC, that is, if seeing the term tells
most of what there is to know about it; the half smooths counts of one. For an identifier of a
single document these are the words of its sentence that at most about N^(1 - THRESHOLD)
documents hold. Such a term is a span wherever it stands in the texts that told it, however far
from the identifier. Where the pair was seen in `support` different sentences or more, that is
evidence beyond one text (copies of a text are one), and the term is a span in every document,
also in those without the identifier. Spans of terms are replaced by a general word, the
identifiers by the names of their kinds.

Patterns are written so that a text costs linear time and fixed stack: a match begins where a
run of its first characters begins, or where the last match ended, and repeats don't backtrack.

Defined cases: a null or empty text has no spans and stays as it is. Offsets are code points,
ends exclusive. Repeated documents are separate rows; ids may be null. Spans of different
kinds may overlap; in the cleaned text the one that begins first, then the longer one, is
replaced, and what overlaps it is dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from weirstone.llm.common import col, saved, text_mark

# What an email, an address, a card and a phone number look like.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
KINDS = ("email", "ip", "card", "phone")
TERM_KIND = "term"

WORD = r"[\p{L}\p{N}]+"
SENTENCE = 500
SENTENCE_END = r"[.!?]\s|\n"
SUPPORT = 2
THRESHOLD = 0.75
# Shortest word that can be a term.
TERM_CHARS = 3
STEP = 64

SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' weighted sum ends in 0."""
    def worth(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + worth(i)) % 10 == 0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body and its lambdas use it."""
    return F.transform(F.array(value), body).getItem(0)


def before_each(lengths: Column) -> Column:
    """Sum of the elements before each, in steps of STEP so that many elements stay cheap."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, b: a + b)

    upto = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STEP).cast("int"))
    blocks = F.transform(upto, lambda b: total(F.slice(lengths, b * STEP + 1, STEP)))

    def within(starts: Column) -> Column:
        def block(b: Column) -> Column:
            own = F.slice(lengths, b * STEP + 1, STEP)
            return let(own, lambda o: F.transform(o, lambda _, i: F.element_at(starts, b + 1) + total(F.slice(o, F.lit(1), i))))

        return F.flatten(F.transform(upto, block))

    starts = let(blocks, lambda held: F.transform(held, lambda _, b: total(F.slice(held, F.lit(1), b))))
    return F.when(F.size(lengths) > 0, let(starts, within)).otherwise(F.array().cast("array<int>"))


def occurrences(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of all matches: the texts between them tell where they stand."""
    def spans(values: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values)), F.length)

        def placed(gap: Column) -> Column:
            steps = F.zip_with(gap, values, lambda g, v: g + F.length(v))
            starts = let(steps, lambda s: F.zip_with(before_each(s), gap, lambda a, g: a + g))
            return F.zip_with(starts, values, lambda s, v: F.struct(s.alias("start"), (s + F.length(v)).alias("end"), v.alias("value")))

        return let(gaps, placed)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def base_spans(text: Column) -> Column:
    """Direct identifiers as array<struct<kind, start, end, value>>, by kind as listed, then by start; values are normalised."""
    likely = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(IP), "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), "phone": F.contains(text, F.lit("+"))}

    def of_kind(number: int, kind: str, pattern: str) -> Column:
        def passes(x: Column) -> Column:
            value = x["value"]
            if kind == "email":
                return F.lit(True)
            if kind == "ip":
                return value.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
            n = F.length(digits_of(value))
            return n.between(13, 19) & luhn(digits_of(value)) if kind == "card" else n.between(9, 15)

        def named(x: Column) -> Column:
            value = F.lower(x["value"]) if kind in ("email", "ip") else digits_of(x["value"])
            return F.struct(F.lit(number).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), value.alias("value"))

        return F.when(likely[kind], F.transform(F.filter(occurrences(text, pattern), passes), named)).otherwise(F.array().cast(SPAN))

    found = [of_kind(i, *pair) for i, pair in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE)))]
    return F.coalesce(F.concat(*found), F.array().cast(SPAN))


def nearby(text: Column, spans: Column) -> Column:
    """array<struct<entity, term, context>>: the whole words of each identifier's sentence that are part of no identifier."""
    def of_sentences(ends: Column) -> Column:
        def around(s: Column) -> Column:
            entity = F.concat(s["kind"].cast("string"), F.lit(":"), s["value"])
            opens = F.coalesce(F.array_max(F.transform(F.filter(ends, lambda e: e["end"] <= s["start"]), lambda e: e["end"])), F.lit(0))
            closes = F.coalesce(F.array_min(F.transform(F.filter(ends, lambda e: e["start"] >= s["end"]), lambda e: e["start"])), F.length(text))
            first, last = F.greatest(opens, s["start"] - SENTENCE), F.least(closes, s["end"] + SENTENCE)
            part = F.substring(text, first + 1, last - first)

            def words(body: Column) -> Column:
                whole = F.filter(occurrences(body, WORD), lambda w: ~((w["start"] == 0) & (first > opens)) & ~((w["end"] == F.length(body)) & (last < closes)))
                free = F.filter(whole, lambda w: (F.length(w["value"]) >= TERM_CHARS)
                    & ~F.exists(spans, lambda o: (w["start"] + first < o["end"]) & (w["end"] + first > o["start"])))
                return F.transform(free, lambda w: F.struct(entity.alias("entity"), F.lower(w["value"]).alias("term"), F.xxhash64(body).alias("context")))

            return let(part, words)

        return F.array_distinct(F.flatten(F.transform(spans, around)))

    return F.when(F.size(spans) > 0, let(occurrences(text, SENTENCE_END), of_sentences))


def words_of(text: Column) -> Column:
    """The different words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def disclosing(pairs: DataFrame, docs: DataFrame, text: str, threshold: float) -> DataFrame:
    """(entity, term, contexts) of `pairs` (rid, entity, term, context): the terms that give an identifier away."""
    n_docs = docs.count()
    entities = pairs.groupBy("entity").agg(F.count_distinct("rid").alias("n_e"))
    # Counted per sentence first: one that stands in many documents is one row from then on.
    seen = pairs.groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
    seen = seen.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count("*").alias("contexts"))
    counts = docs.select(F.explode(words_of(col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    known = seen.join(counts, "term").join(entities, "entity")
    # PMI >= threshold * IC without logarithms; a document with two sentences of a pair counts once at most.
    both = F.least("n_et", "n_e", "n_t").cast("double")
    tells = both * n_docs / (F.col("n_e") * (F.col("n_t") + 0.5)) >= F.pow(F.lit(float(n_docs)) / F.col("n_e"), F.lit(threshold))
    return known.where(tells).select("entity", "term", "contexts")


def find(docs: DataFrame, carry: list[str], *, text: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """(row, base, terms) for every document; `row` holds the columns `carry`.

    `base` lists direct identifiers (kind, start, end, value), `terms` the spans (start, end) of what discloses them.
    Texts are told apart by 128 bits, so that one is looked through for its own terms once, however many copies it has.
    """
    body = docs.select(F.struct(*map(col, carry)).alias("row"), col(text).alias("text"), text_mark(col(text)).alias("mark"))
    rows = body.withColumn("base", base_spans(F.col("text"))).withColumn("rid", F.monotonically_increasing_id())
    rows = rows.withColumn("near", nearby(F.col("text"), F.col("base")))
    # Only texts with identifiers are written, and moved later on.
    rows = rows.withColumn("body", F.when(F.size("base") > 0, F.col("text"))).drop("text")
    marked = saved(rows, "identifiers")  # numbers stay what they are once written
    pairs = saved(marked.where(F.size("near") > 0).select("rid", "mark", F.inline("near")), "pairs")
    told = saved(disclosing(pairs, docs, text, threshold), "told")
    chosen = pairs.join(told, ["entity", "term"]).select("mark", "term").distinct().groupBy("mark").agg(F.collect_list("term").alias("chosen"))
    held = marked.where(F.size("base") > 0).select("mark", "body").dropDuplicates(["mark"]).join(chosen, "mark")
    spots = held.select("mark", F.inline(F.filter(occurrences(F.col("body"), WORD), lambda w: F.array_contains("chosen", F.lower(w["value"])))))
    spots = spots.select("mark", "start", "end")
    known = saved(told.where(F.col("contexts") >= support).select("term").distinct(), "known")
    if not known.isEmpty():
        words = docs.select(text_mark(col(text)).alias("mark"), F.inline(occurrences(col(text), WORD)))
        words = words.select("mark", "start", "end", F.lower("value").alias("term"))
        spots = spots.unionByName(words.join(known, "term", "left_semi").drop("term"))
    placed = spots.distinct().groupBy("mark").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("at"))
    found = marked.select("row", "mark", "base").join(placed, "mark", "left")
    free = F.filter("at", lambda w: ~F.exists("base", lambda s: (w["start"] < s["end"]) & (w["end"] > s["start"])))
    return found.select("row", "base", F.coalesce(free, F.array().cast("array<struct<start:int,end:int>>")).alias("terms"))


def listed(spans: Column) -> Column:
    """`kind:start:end` of every span, comma-joined."""
    names = F.array(*map(F.lit, (*KINDS, TERM_KIND)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def all_spans(base: Column, terms: Column) -> Column:
    """Direct and disclosing spans as array<struct<kind, start, end>>, by kind, then by start."""
    direct = F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.concat(direct, F.transform(terms, lambda s: F.struct(F.lit(len(KINDS)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))


def sanitise(docs: DataFrame, *, text: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with identifiers replaced by [EMAIL], [IP], [CARD] or [PHONE] and disclosing terms by [TERM]."""
    found = find(docs, docs.columns, text=text, support=support, threshold=threshold)
    body = F.col("row").getField(text)
    masks = F.array(*[F.lit(f"[{k.upper()}]") for k in (*KINDS, TERM_KIND)])
    by_place = F.array_sort(F.transform(all_spans(F.col("base"), F.col("terms")), lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    # A span that begins before the furthest end so far lies on another one.
    start = F.struct(F.lit(0).alias("upto"), F.array().cast("array<struct<start:int,end:int,kind:int>>").alias("kept"))

    def step(acc: Column, s: Column) -> Column:
        span = F.struct(s["start"].alias("start"), (-s["back"]).alias("end"), s["kind"].alias("kind"))
        return F.when(s["start"] >= acc["upto"], F.struct((-s["back"]).alias("upto"), F.concat(acc["kept"], F.array(span)).alias("kept"))).otherwise(acc)

    kept = F.aggregate(by_place, start, step)["kept"]
    froms = F.concat(F.array(F.lit(0)), F.transform("kept", lambda s: s["end"]))
    pieces = F.transform("kept", lambda s, i: F.concat(
        F.substring(F.col("body"), F.element_at("froms", i + 1) + 1, s["start"] - F.element_at("froms", i + 1)), F.element_at(masks, s["kind"] + 1)
    ))
    cut = found.select("row", body.alias("body"), kept.alias("kept")).withColumn("froms", froms.cast("array<int>"))
    cleaned = F.concat(F.array_join(pieces, ""), F.substring(F.col("body"), F.element_at("froms", -1) + 1, F.length("body")))
    cut = cut.select("row", F.when(F.size("kept") > 0, cleaned).otherwise(F.col("body")).alias("cleaned"))
    return cut.select(*[F.col("cleaned").alias(text) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
