"""Personal data by pattern, and the terms that give it away by co-occurrence.

Patterns find e-mail and IP addresses, card and phone numbers. Each distinct value is a protected
entity. The corpus then says how much a term tells about an entity it stands near: their pointwise
mutual information as a share of the entity's own information content (1: whoever reads the term
knows the entity). Terms above one threshold are generalised wherever they occur, above the other
removed. Everything is DataFrame expressions; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import written

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: The kinds' patterns, written so that no run of characters is tried from more than one start:
#: a search that fails at the first character of a run fails at all others.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM = r"[\p{L}\p{N}]+"
#: Terms on either side of an entity that count as standing near it.
CONTEXT = 5
#: Distinct texts in which a term stands near an entity before it is judged.
SUPPORT = 5
#: Share of an entity's information content that a term may tell.
GENERALISE, REMOVE = 0.9, 0.97
_BLOCK = 128


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    reverse = F.reverse(_digits(value))

    def weight(i: Column) -> Column:
        digit = F.substr(reverse, i, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(i % 2 == 1, digit).when(doubled > 9, doubled - 9).otherwise(doubled)

    places = F.transform(F.sequence(F.lit(1), F.char_length(reverse)), weight)
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.char_length(_digits(value)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """One spelling for each protected value."""
    plain = F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)
    return F.concat(F.lit(f"{kind}:"), plain)


def running_sums(df: DataFrame, values: str, sums: str) -> DataFrame:
    """``df`` with the running sums of the int array ``values``: sums of blocks first, so long arrays stay cheap."""
    numbers, sizes, bases = F.col(values), F.col("_sizes"), F.col("_bases")
    none = F.array().cast("array<int>")

    def cumulate(array: Column, start: Column) -> Column:
        first = F.struct(start.alias("total"), none.alias("out"))
        step = lambda a, v: F.struct((a["total"] + v).alias("total"), F.concat(a["out"], F.array(a["total"] + v)).alias("out"))
        return F.aggregate(array, first, step, lambda a: a["out"])

    def block(b: Column) -> Column:
        return F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK))

    count = F.floor((F.size(numbers) + (_BLOCK - 1)) / _BLOCK).cast("int")
    each = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(none)
    df = df.withColumn("_sizes", F.transform(each, lambda b: F.aggregate(block(b), F.lit(0), lambda x, y: x + y)))
    df = df.withColumn("_bases", cumulate(sizes, F.lit(0)))
    parts = F.transform(bases, lambda base, b: cumulate(block(b), base - F.element_at(sizes, b + 1)))
    return df.withColumn(sums, F.flatten(parts)).drop("_sizes", "_bases")


def _with_matches(df: DataFrame, pattern: str, name: str, where: Column | None = None) -> DataFrame:
    """``df`` with ``name``, an array of (value, start, stop) of the matches in ``text``, in code points."""
    hits, length, stop = f"_{name}_hits", f"_{name}_length", f"_{name}_stop"
    searched = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    if where is not None:
        searched = F.when(where, searched).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(hits, searched)
    gaps = F.transform(F.split("text", pattern, -1), F.char_length)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: gap + F.char_length(hit))
    df = df.withColumn(length, F.when(F.size(hits) > 0, steps).otherwise(F.array().cast("array<int>")))
    df = running_sums(df, length, stop)
    spans = F.zip_with(
        hits, stop, lambda v, s: F.struct(v.alias("value"), (s - F.char_length(v)).alias("start"), s.alias("stop"))
    )
    return df.withColumn(name, spans).drop(hits, length, stop)


def _value_holds(kind: str):
    return lambda x: _valid(kind, x["value"])


def _always(name: str):
    return lambda x: F.lit(name)


def with_base_spans(df: DataFrame) -> DataFrame:
    """``df`` (with ``text``) and one array of (value, start, stop) for each of KINDS."""
    for kind in KINDS:
        df = _with_matches(df, PATTERNS[kind], kind)
        df = df.withColumn(kind, F.filter(kind, _value_holds(kind)))
    return df


def _texts(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("_h"))


def _mentions(texts: DataFrame) -> DataFrame:
    """_h and ``mentions``, an array of (entity, terms near it), of the documents with personal data."""
    hits = [F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0)).alias(k) for k in KINDS]
    found = texts.select("_h", "text", *hits).where(" OR ".join(f"size({k}) > 0" for k in KINDS))

    def terms(pieces: Column) -> Column:
        return F.transform(pieces, lambda p: F.transform(F.regexp_extract_all(p, F.lit(TERM), F.lit(0)), F.lower))

    for kind in KINDS:
        pieces = F.when(F.size(kind) > 0, terms(F.split("text", PATTERNS[kind], -1)))
        found = found.withColumn(f"_{kind}", pieces)

    def of(kind: str) -> Column:
        pieces = F.col(f"_{kind}")

        def mention(value: Column, i: Column) -> Column:
            before, after = F.element_at(pieces, i + 1), F.element_at(pieces, i + 2)
            tail = F.slice(before, F.greatest(F.lit(1), F.size(before) - (CONTEXT - 1)), F.lit(CONTEXT))
            near = F.concat(tail, F.slice(after, 1, CONTEXT))
            return F.struct(_valid(kind, value).alias("ok"), _entity(kind, value).alias("entity"), near.alias("terms"))

        return F.filter(F.transform(kind, mention), lambda m: m["ok"])

    found = found.select("_h", F.concat(*[of(k) for k in KINDS]).alias("mentions"))
    return found.where(F.size("mentions") > 0)


def _terms(texts: DataFrame) -> DataFrame:
    """(_h, term) once for each document and distinct term."""
    words = F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    return texts.select("_h", F.explode(F.array_distinct(F.transform(words, F.lower))).alias("term"))


def disclosing_terms(
    documents: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """(term, disclosure, level) of the terms that tell more than a share ``generalise`` of some entity.

    Counts are documents: of the entity, of the term anywhere, of the term near the entity, copies
    included. ``support`` counts distinct texts, so copies of one text never make a term telling.
    An entity that every document holds tells nothing.
    """
    texts = _texts(documents)
    mentions = _mentions(texts)
    entities = F.array_distinct(F.transform("mentions", lambda m: m["entity"]))
    entities = mentions.select(F.explode(entities).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    # No entity or term holds a blank, so a pair is one string.
    pairs = F.flatten(F.transform("mentions", lambda m: F.transform(m["terms"], lambda t: F.concat_ws(" ", m["entity"], t))))
    near = mentions.select("_h", F.explode(F.array_distinct(pairs)).alias("pair"))
    near = near.groupBy("pair", "_h").agg(F.count(F.lit(1)).alias("n"))
    near = near.groupBy("pair").agg(F.sum("n").alias("n_near"), F.count(F.lit(1)).alias("n_texts"))
    near = near.where(F.col("n_texts") >= support).select(
        F.substring_index("pair", " ", 1).alias("entity"), F.substring_index("pair", " ", -1).alias("term"), "n_near"
    )
    counts = _terms(texts).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    n_all = texts.agg(F.count(F.lit(1)).alias("n")).scalar()
    told = 1 - F.log(F.col("n_term") / F.col("n_near")) / F.log(n_all / F.col("n_entity"))
    judged = near.join(entities, "entity").where(F.col("n_entity") < n_all).join(counts, "term")
    judged = judged.groupBy("term").agg(F.max(told).alias("disclosure")).where(F.col("disclosure") >= generalise)
    level = F.when(F.col("disclosure") >= remove, "removed").otherwise("generalised")
    return judged.withColumn("level", level)


def find_spans(documents: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """doc_id, text, the arrays of KINDS and ``terms``, (value, start, stop, level) of disclosing terms outside them.

    One row per input row. A null or empty text has no spans; rows without doc_id and repeated rows
    are each judged by their text alone. Columns other than doc_id and text are not read. An empty
    table gives an empty one. Offsets are code points of the whole text.
    """
    texts = _texts(documents)
    telling = written(disclosing_terms(documents, support, generalise, remove), "disclosing-terms")
    of_text = _terms(texts).join(telling.select("term", "level"), "term").select("_h", F.struct("term", "level").alias("t"))
    of_text = of_text.distinct().groupBy("_h").agg(F.map_from_entries(F.collect_list("t")).alias("_told"))
    of_text = written(of_text, "disclosing-texts")
    rows = with_base_spans(texts.join(of_text, "_h", "left"))
    # Words are placed only in texts with a disclosing term.
    rows = _with_matches(rows, TERM, "terms", F.col("_told").isNotNull())
    base = F.concat(*KINDS)

    def added(word: Column) -> Column:
        return F.element_at("_told", F.lower(word["value"])).isNotNull() & ~F.exists(
            base, lambda b: (b["start"] < word["stop"]) & (word["start"] < b["stop"])
        )

    terms = F.transform(F.filter("terms", added), lambda w: w.withField("level", F.element_at("_told", F.lower(w["value"]))))
    return rows.select("doc_id", "text", *KINDS, terms.alias("terms"))


def _listed(*spans: tuple[Column, Column]) -> Column:
    """All (array, name of a span) as kind:start:stop, comma-joined, by start and then in the order given."""

    def ranked(array: Column, i: int, name) -> Column:
        return F.transform(
            array, lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("i"), x["stop"].alias("stop"), name(x).alias("kind"))
        )

    ordered = F.array_sort(F.concat(*[ranked(array, i, name) for i, (array, name) in enumerate(spans)]))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    base = [(F.col(k), _always(k)) for k in KINDS]
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(*base), 256).alias("base_sha256"),
        _listed(*base, (F.col("terms"), lambda x: x["level"])).alias("spans"),
    )


def sanitised(found: DataFrame) -> DataFrame:
    """doc_id and ``text`` with personal data and disclosing terms replaced.

    Personal data becomes the name of its kind, a removed term three dots, a generalised term the
    class it belongs to. Spans that overlap are replaced together, by the name of the first.
    """
    text = F.col("text")

    def class_of(x: Column) -> Column:
        word = x["value"]
        kind = F.when(word.rlike(r"\p{N}"), "number").when(word.rlike(r"^\p{Lu}"), "name").otherwise("word")
        return F.when(x["level"] == "removed", "...").otherwise(F.concat(F.lit("<"), kind, F.lit(">")))

    def places(array: Column, name) -> Column:
        return F.transform(array, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), name(x).alias("name")))

    parts = [places(F.col(k), _always(f"<{k}>")) for k in KINDS] + [places(F.col("terms"), class_of)]
    rows = found.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("_all"))

    def put(done: Column, x: Column) -> Column:
        gap = F.substr(text, done["at"] + 1, F.greatest(F.lit(0), x["start"] - done["at"]))
        fresh = x["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], x["stop"]).alias("at"),
            F.when(fresh, F.concat(done["out"], gap, x["name"])).otherwise(done["out"]).alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("_all", first, put, lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1)))
    return rows.select("doc_id", clean.alias("text"))
