"""Personal data found by form, and the words that give it away, in DataFrame operations only.

The base finds addresses, IPs, cards and phone numbers. A protected entity is such a value. A word
of a text that holds it discloses it as far as ``PMI(entity; word) / IC(entity)`` says, with probabilities from
the documents of the corpus: the information content ``IC = log(N / n_entity)`` is what the word
would have to reveal, the pointwise mutual information what it does reveal. Words at or over a
threshold are generalised wherever they stand in such a text, or removed if they occur with nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import whole_text
from parcelpulse.session import staged

KINDS = ("email", "ip", "card", "phone")
#: The forms of the four kinds. Runs are possessive and starts inside a run that an earlier start
#: would have matched are skipped: the matches stay the same, at a cost linear in the text and
#: without recursion.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a match of a kind that counts; cheap to ask.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
IP = "^" + r"\.".join([r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"] * 4) + "$"
#: A word in letters, whatever stands around it.
WORD = r"\p{L}{3,}+"
SLICE = 256
SPAN = "struct<kind:string,start:bigint,stop:bigint,value:string>"


@dataclass(frozen=True)
class Disclosure:
    """A word is treated from ``threshold`` of the entity's information on.

    From ``support`` documents with both on, the share of the word's documents that hold the entity is
    taken as counted. Below, it is the lower end of Wilson's interval of ``z`` deviations (0.84: four
    times in five the true share is above), so that one or two documents say less, but are heard: a
    word seen once, with an entity seen once, discloses it from a corpus of 210 documents on.
    """

    threshold: float = 0.9
    support: int = 3
    z: float = 0.84


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row: no filter on them is pushed below and repeats their work."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _slices(items: Column) -> Column:
    """The array in slices, so that appending within a slice costs little whatever its length."""
    last = F.floor((F.size(items) - 1) / SLICE).cast("int")
    return F.when(
        F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * SLICE + 1, SLICE))
    ).otherwise(F.slice(F.array(items), 1, 0))


def _items(matches: Column, gaps: Column) -> Column:
    """Each match with the length of the text before it since the last one."""
    return F.transform(matches, lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), m.alias("m")))


def _spans(kind: str, slices: Column) -> Column:
    """SPANs of the slices of items: the sizes of gaps and matches add up to places."""
    none = F.array().cast(f"array<{SPAN}>")

    def add(acc: Column, x: Column) -> Column:
        start = acc.at + x.gap
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(x.m)).alias("stop"), x.m.alias("value"),
        )
        return F.struct((start + F.length(x.m)).alias("at"), F.concat(acc.out, F.array(span)).alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    parts = F.transform(slices, lambda part: F.aggregate(part, zero, add))

    def move(acc: Column, part: Column) -> Column:
        moved = F.transform(part.out, lambda s: s.withField("start", s.start + acc.at).withField("stop", s.stop + acc.at))
        return F.struct((acc.at + part.at).alias("at"), F.concat(acc.out, F.array(moved)).alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out"))
    return F.filter(F.flatten(F.aggregate(parts, first, move).out), lambda s: _counts(kind, s.value))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    turned = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(turned, i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) % 10 == 0


def _counts(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP)
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def with_base_spans(docs: DataFrame, text: str = "text", into: str = "pii_") -> DataFrame:
    """All columns of ``docs`` with ``<into>text``, the whole text, and ``<into>spans``, the base's SPANs
    in order of KINDS and place. Places are code points from 0, the stop is exclusive."""
    out = docs.withColumn(f"{into}text", whole_text(text))
    body = F.col(f"{into}text")
    none = F.array().cast("array<string>")
    pieces = {}
    for kind in KINDS:
        hint = F.contains(body, F.lit(HINTS[kind])) if kind == "email" else body.rlike(HINTS[kind])
        pieces[f"{into}m_{kind}"] = F.when(hint, F.regexp_extract_all(body, F.lit(FORMS[kind]), F.lit(0))).otherwise(none)
        pieces[f"{into}g_{kind}"] = F.when(hint, F.split(body, FORMS[kind], -1)).otherwise(none)
    out = out.withColumns(pieces)
    items = {f"{into}i_{k}": _items(F.col(f"{into}m_{k}"), F.col(f"{into}g_{k}")) for k in KINDS}
    out = out.withColumns(items).drop(*pieces)
    slices = {f"{into}p_{k}": _slices(F.col(f"{into}i_{k}")) for k in KINDS}
    out = out.withColumns(slices).drop(*items)
    spans = F.concat(*(_spans(k, F.col(f"{into}p_{k}")) for k in KINDS))
    return settled(out, **{f"{into}spans": spans}).drop(*slices)


def _entity(span: Column) -> Column:
    value = F.when(span.kind.isin("card", "phone"), _digits(span.value)).otherwise(F.lower(span.value))
    return F.struct(span.kind.alias("kind"), value.alias("value"))


def _words(text: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _signature(key: str) -> list[Column]:
    """Aggregates that are equal for equal sets of texts: 128 bits of the texts' hashes."""
    return [F.bit_xor(F.xxhash64(key)).alias("sig_a"), F.bit_xor(F.xxhash64(F.lit(1), key)).alias("sig_b")]


def _share(both: Column, term: Column, disclosure: Disclosure) -> Column:
    """The share of a word's documents that hold the entity: as counted, or its lower bound if both are rare together."""
    p, z2 = both / term, disclosure.z**2
    spread = F.sqrt(F.greatest(p * (1 - p), F.lit(0.0)) / term + z2 / (4 * term * term))
    low = (p + z2 / (2 * term) - disclosure.z * spread) / (1 + z2 / term)
    return F.when(both >= disclosure.support, p).otherwise(low)


def disclosing_terms(
    based: DataFrame, texts: DataFrame, disclosure: Disclosure = Disclosure(), into: str = "pii_"
) -> DataFrame:
    """(key, told): for each text with base spans, known by its hash, the words to treat.

    ``based`` comes from ``with_base_spans``, ``texts`` has the column text of the same rows. Counts are
    over all rows: copies of a text count as often as they occur, but travel once. ``told`` has (term,
    alone): alone, if the word occurs in no document without the entity; a word that discloses two is
    alone only if it is for both. An entity in every document discloses nothing and is left out.

    Words too frequent to disclose any entity of their text go before pairs are made. Entities that
    stand in the same texts have equal counts with every word, so they are one class, and so are words
    of the same texts: a directory of thousands of addresses found nowhere else is one class, and with the
    words found nowhere else it makes one pair. Pairs of a text are made by a join, whose large keys adaptive
    execution splits, and are summed before they are shuffled.
    """
    spans = F.col(f"{into}spans")
    contexts = (
        based.where(F.size(spans) > 0)
        .select(
            F.sha2(f"{into}text", 256).alias("key"),
            F.array_distinct(F.transform(spans, _entity)).alias("entities"),
            _words(f"{into}text").alias("words"),
        )
        .groupBy("key")
        .agg(F.first("entities").alias("entities"), F.first("words").alias("words"), F.count(F.lit(1)).alias("copies"))
    )
    contexts = staged(contexts, "pii-contexts")
    rows = texts.agg(F.count(F.lit(1)).alias("n")).first().n
    information = F.log(F.lit(float(max(rows, 1))) / F.col("n_entity"))
    # a word of more documents than this is not told, however many of the entity's documents hold it
    most = F.col("n_entity") * F.exp((1 - disclosure.threshold) * information) * (1 + 1e-9)
    holds = contexts.select("key", "copies", F.explode("entities").alias("e")).select("key", "copies", "e.kind", "e.value")
    of_entity = holds.groupBy("kind", "value").agg(F.sum("copies").alias("n_entity"), *_signature("key"))
    of_entity = of_entity.where(F.col("n_entity") < rows).withColumn("most", most)
    ids = F.struct("sig_a", "sig_b", "n_entity").alias("entity")
    entities = holds.join(of_entity, ["kind", "value"]).select("key", "copies", "most", ids).distinct()
    entities = staged(entities, "pii-entities")
    limits = entities.groupBy("key").agg(F.max("most").alias("most"))
    of_term = texts.select(F.explode(_words("text")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    words = contexts.join(limits, "key").select("key", "most", F.explode("words").alias("term"))
    words = staged(words.join(of_term, "term").where(F.col("n_term") <= F.col("most")).select("key", "term", "n_term"), "pii-words")
    of_word = words.groupBy("term").agg(*_signature("key"))
    # sets of the texts where a word may be told; the others make no pairs with it
    ids = F.struct("sig_a", "sig_b", "n_term").alias("word")
    words = staged(words.join(of_word, "term").select("key", "term", ids), "pii-word-classes")
    pairs = entities.join(words.select("key", "word").distinct(), "key").where(F.col("word.n_term") <= F.col("most"))
    both = pairs.groupBy("entity", "word").agg(F.sum("copies").alias("n_both"))
    share = _share(F.col("n_both"), F.col("word.n_term"), disclosure)
    told = 1 + F.log(share) / F.log(F.lit(float(max(rows, 1))) / F.col("entity.n_entity"))
    told = both.where(told >= disclosure.threshold).select("entity", "word", (F.col("word.n_term") <= F.col("n_both")).alias("alone"))
    told = pairs.join(staged(told, "pii-told"), ["entity", "word"]).groupBy("key", "word").agg(F.min("alone").alias("alone"))
    return words.join(told, ["key", "word"]).groupBy("key").agg(F.collect_list(F.struct("term", "alone")).alias("told"))


def _with_places(held: DataFrame, into: str) -> DataFrame:
    """Adds ``<into>terms``: every place of the words in ``<into>told`` that no base span covers."""
    body, told = F.col(f"{into}text"), F.col(f"{into}told")
    none = F.array().cast("array<string>")
    # settled, as the lambdas below would split the text anew for every word
    held = settled(
        held,
        **{
            f"{into}m": F.when(told.isNotNull(), F.regexp_extract_all(body, F.lit(WORD), F.lit(0))).otherwise(none),
            f"{into}g": F.when(told.isNotNull(), F.split(body, WORD, -1)).otherwise(none),
            f"{into}of": F.map_from_entries(told),
        },
    ).drop(f"{into}told")
    held = settled(held, **{f"{into}i": _items(F.col(f"{into}m"), F.col(f"{into}g"))}).drop(f"{into}m", f"{into}g")
    held = settled(held, **{f"{into}p": _slices(F.col(f"{into}i"))}).drop(f"{into}i")
    held = settled(held, **{f"{into}w": _spans("term", F.col(f"{into}p"))}).drop(f"{into}p")
    marked = F.transform(
        f"{into}w", lambda w: F.struct(w.start.alias("start"), w.stop.alias("stop"), F.try_element_at(F.col(f"{into}of"), F.lower(w.value)).alias("alone"))
    )
    clear = F.filter(
        F.filter(marked, lambda w: w.alone.isNotNull()),
        lambda w: ~F.exists(f"{into}spans", lambda s: (s.start < w.stop) & (w.start < s.stop)),
    )
    return settled(held, **{f"{into}terms": clear}).drop(f"{into}w", f"{into}of")


def find(docs: DataFrame, disclosure: Disclosure = Disclosure(), text: str = "text", into: str = "pii_") -> DataFrame:
    """All columns of ``docs`` with ``<into>text``, ``<into>spans`` and ``<into>terms``.

    A null text is the empty text. Rows without personal data keep out of the join; rows with it
    are joined by their text's hash, so repeated rows and null ids need no care, and copies that
    make up a large part of the rows are a skewed key that adaptive execution splits. Tables
    without rows or without personal data give no terms.
    """
    based = with_base_spans(docs, text, into)
    terms = staged(disclosing_terms(based, docs.select(whole_text(text).alias("text")), disclosure, into), "pii-terms")
    none = F.array().cast("array<struct<start:bigint,stop:bigint,alone:boolean>>")
    size = F.size(f"{into}spans")
    clean = based.where(size == 0).withColumn(f"{into}terms", none)
    held = based.where(size > 0).withColumn(f"{into}key", F.sha2(f"{into}text", 256))
    found = terms.select(F.col("key").alias(f"{into}key"), F.col("told").alias(f"{into}told"))
    held = _with_places(held.join(found, f"{into}key", "left").drop(f"{into}key"), into)
    return clean.unionByName(held)


def _free_prefix(docs: DataFrame) -> str:
    """A prefix that no column of the table begins with."""
    into = "pii_"
    while any(c.lower().startswith(into) for c in docs.columns):
        into = f"_{into}"
    return into


def sanitise(docs: DataFrame, disclosure: Disclosure = Disclosure(), text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced by its kind, and disclosing words by a general one or nothing.

    All other columns stay, whatever their names. A null text stays null.
    """
    into = _free_prefix(docs)
    found = find(docs, disclosure, text, into)
    body = F.col(f"{into}text")
    base = F.transform(
        f"{into}spans",
        lambda s: F.struct(s.start.alias("start"), s.stop.alias("stop"), F.concat(F.lit("["), F.upper(s.kind), F.lit("]")).alias("label")),
    )
    general = F.transform(
        f"{into}terms",
        lambda t: F.struct(t.start.alias("start"), t.stop.alias("stop"), F.when(t.alone, "").otherwise("[TERM]").alias("label")),
    )
    found = found.withColumn(f"{into}cuts", F.array_sort(F.concat(base, general)))
    found = found.withColumn(f"{into}slices", _slices(F.col(f"{into}cuts")))
    ends = F.transform(f"{into}slices", lambda part: F.array_max(F.transform(part, lambda c: c.stop)))
    found = found.withColumn(f"{into}ends", ends)

    def part(cuts: Column, i: Column) -> Column:
        """A slice of cuts with the text from the end of the slice before to its own end."""
        begin = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(f"{into}ends", i - 1))
        piece = F.substring(body, begin + 1, F.greatest(F.get(f"{into}ends", i) - begin, F.lit(0)))
        return F.struct(cuts.alias("cuts"), begin.alias("begin"), piece.alias("piece"))

    def cleaned(x: Column) -> Column:
        def add(acc: Column, c: Column) -> Column:
            clear = F.substring(x.piece, acc.at - x.begin + 1, F.greatest(c.start - acc.at, F.lit(0)))
            out = F.when(c.stop > acc.at, F.concat(acc.out, clear, c.label)).otherwise(acc.out)
            return F.struct(F.greatest(acc.at, c.stop).alias("at"), out.alias("out"))

        return F.aggregate(x.cuts, F.struct(x.begin.alias("at"), F.lit("").alias("out")), add).out

    found = settled(found, **{f"{into}parts": F.transform(f"{into}slices", part)})
    last = F.array_max(f"{into}ends")
    whole = F.concat(F.concat_ws("", F.transform(f"{into}parts", cleaned)), F.substring(body, last + 1, F.length(body)))
    found = found.withColumn(text, F.when(F.size(f"{into}cuts") == 0, F.col(text)).otherwise(whole))
    return found.select(*(f"`{c}`" for c in docs.columns))


def spans_digest(found: DataFrame, id_column: str = "doc_id", into: str = "pii_") -> DataFrame:
    """doc_id, a count per kind, the hash of the base spans, and all spans as text."""
    spans, terms = F.col(f"{into}spans"), F.col(f"{into}terms")
    base = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop))
    more = F.transform(terms, lambda t: F.concat_ws(":", F.lit("term"), t.start, t.stop))
    counts = [F.size(_of(spans, kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        F.col(id_column).alias("doc_id"), *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, more), ",").alias("spans"),
    )


def _of(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s.kind == kind)
