"""Personal data and the terms that give it away, by information-theoretic sanitisation.

Addresses, numbers and the like are found by patterns; each different value is a
protected entity. How strongly a term near an entity reveals it is estimated from the
corpus: the pointwise mutual information of term and entity over different texts, as a
share of the entity's own information. The chance of the entity given the term enters it
as the lower end of its confidence interval (Wilson), so a term that occurs only where the
entity does reveals the more of it the more texts say so; one text counts, but for less.
Terms above one threshold are removed, those above a lower one generalised, wherever they
stand. Since any share of an entity's information becomes easier to reach as the table
grows, the lower end itself must reach a fixed chance as well, at every size: one meeting
of term and entity is evidence only if the term stands in no other text.

Everything is SQL functions and joins. Patterns run iteratively in the JVM's engine: what
would be a repeated group is first marked by a character of its own (same length), so
that a plain character class repeats and no text, however long, exhausts the stack.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import cut, small_side

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: A private-use character marks separators inside an address or number; its own occurrences become another one.
MARK, OTHER = "\ue000", "\ue001"

#: Words on either side that count as near, characters searched for them, least letters of a term.
NEAR_WORDS, NEAR_CHARS, LETTERS = 8, 160, 3
#: Standard errors from an estimated chance to the lower end of its interval (95%, one-sided).
CONFIDENCE = 1.645
#: Share of an entity's information at which a term is removed, and at which it is generalised.
REMOVE, GENERALISE = 0.9, 0.6
#: Least lower end of the chance of the entity given the term; 1 of 1, 2 of 3 and 3 of 5 texts reach it, 1 of 2 does not.
LEAST_CHANCE = 0.25

#: Flagged terms, marked and repeated texts are broadcast up to this many bytes; they grow with the entities.
HELD_BYTES = 64 << 20

_LOCAL = f"A-Za-z0-9._%+{MARK}-"
_EMAIL = f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]+@[A-Za-z0-9-]+{MARK}[A-Za-z0-9{MARK}-]+"
_IP = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
_CARD = f"(?<![0-9{MARK}])[0-9{MARK}]{{13,}}"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_SPAN = "array<struct<start: int, end: int, value: string>>"


def _spans(text: Column, pattern: Column | str, kept: Column | None = None) -> Column:
    """Start, end (code points) and value of all matches, from the lengths of the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    both = F.zip_with(found, pieces, lambda m, p: F.struct(m.alias("m"), F.length(p).alias("gap")))
    # The piece after the last match has no match beside it.
    both = F.filter(both, lambda x: x["m"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["m"])
        one = F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    return F.aggregate(both, start, step, lambda acc: acc["spans"])


def _marked(text: Column, around: str, separators: str) -> Column:
    """Single separators between two characters of a class become the mark."""
    return F.regexp_replace(F.translate(text, MARK, OTHER), f"(?<=[{around}])[{separators}](?=[{around}])", MARK)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def _part_fits(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+", "")
    return (F.length(short) <= 3) & (F.coalesce(F.substring(short, 1, 3).try_cast("int"), F.lit(0)) <= 255)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind in a text column without NULLs."""
    none = F.array().cast(_SPAN)
    email = F.when(F.instr(text, "@") > 0, _spans(_marked(text, "A-Za-z0-9-", "."), _EMAIL)).otherwise(none)
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), _spans(text, _IP)).otherwise(none)
    card = F.when(text.rlike(r"[0-9][0-9\x20-]{11}"), _spans(_marked(text, "0-9", r"\x20-"), _CARD)).otherwise(none)
    phone = F.when(F.instr(text, "+") > 0, _spans(text, _PHONE)).otherwise(none)

    def card_fits(x: Column) -> Column:
        n = F.length(_digits(x["value"]))
        return F.when((n >= 13) & (n <= 19), _luhn(_digits(x["value"]))).otherwise(False)

    return {
        "email": email,
        "ip": F.filter(ip, lambda x: F.forall(F.split(x["value"], r"\."), _part_fits)),
        "card": F.filter(card, card_fits),
        "phone": F.filter(phone, lambda x: F.length(_digits(x["value"])).between(9, 15)),
    }


def _entity(kind: str, value: Column) -> Column:
    """The same address or number however written."""
    plain = F.lower(F.translate(value, MARK, ".")) if kind == "email" else value if kind == "ip" else _digits(value)
    return F.concat(F.lit(f"{kind}:"), plain)


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"\\p{{L}}{{{LETTERS},}}"), F.lit(0))


def _near(text: Column, span: Column) -> Column:
    """Terms on either side of a span; a word cut off by the search's reach is left out."""
    begin = F.greatest(span["start"] - NEAR_CHARS, F.lit(0))
    before = _terms(F.substring(text, begin + 1, span["start"] - begin))
    before = F.when((begin > 0) & (F.size(before) > 0), F.slice(before, F.lit(2), F.greatest(F.size(before) - 1, F.lit(0)))).otherwise(before)
    before = F.slice(F.reverse(before), 1, NEAR_WORDS)
    after = F.substring(text, span["end"] + 1, F.lit(NEAR_CHARS))
    behind = _terms(after)
    behind = F.when((F.length(after) == NEAR_CHARS) & (F.size(behind) > 0), F.slice(behind, F.lit(1), F.greatest(F.size(behind) - 1, F.lit(0)))).otherwise(behind)
    return F.array_distinct(F.concat(before, F.slice(behind, 1, NEAR_WORDS)))


def _key(text: Column) -> Column:
    """Two 64-bit hashes: equal texts are one in all statistics."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))


def _found(docs: DataFrame) -> DataFrame:
    """Base spans of each row, and each span's entity with the terms near it."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = base_spans(F.col("text"))
    rows = rows.select("doc_id", _key(F.col("text")).alias("key"), "text", *[c.alias(k) for k, c in spans.items()])

    def with_terms(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(_entity(kind, x["value"]).alias("entity"), _near(F.col("text"), x).alias("terms")))

    near = F.concat(*[with_terms(k) for k in KINDS])
    bare = [F.transform(F.col(k), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias(k) for k in KINDS]
    return rows.select("doc_id", "key", *bare, near.alias("near"))


def _lower_end(hits: Column, of: Column) -> Column:
    """Lower end of Wilson's interval of a share."""
    z = CONFIDENCE**2
    share = hits / of
    return (share + z / (2 * of) - CONFIDENCE * F.sqrt(share * (1 - share) / of + z / (4 * of * of))) / (1 + z / of)


def revealing_terms(found: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terms that reveal an entity (``term``, ``disclosure``, ``action``), and where they occur (``key``, ``term``).

    ``found`` holds the entities of ``docs``. Counts are of different texts, over all of them.
    Every entity and every term near it is scored, also those of a single text.
    """
    entities = found.where(F.size("near") > 0).select("key", F.explode("near").alias("n")).select("key", "n.entity", "n.terms")
    per_entity = entities.select("entity", "key").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = entities.join(per_entity, "entity").select("entity", "n_entity", "key", F.explode("terms").alias("term")).distinct()
    pairs = cut(pairs.groupBy("entity", "n_entity", "term").agg(F.count(F.lit(1)).alias("n_both")))
    texts = float(found.select("key").distinct().agg(F.count(F.lit(1)).alias("n")).first()["n"])

    def share(n_term: str) -> Column:
        """ln(chance * texts / n_entity) against ln(texts / n_entity), with the lower end of n_both / n_term as chance.

        It falls with n_term and grows with n_both. Without enough evidence it is 0.
        """
        chance = _lower_end(F.col("n_both"), F.col(n_term))
        mutual = F.log(chance * F.lit(texts) / F.col("n_entity"))
        own = F.log(F.lit(texts) / F.col("n_entity"))
        return F.when((own > 0) & (chance >= LEAST_CHANCE), mutual / own).otherwise(F.lit(0.0))

    # A term is in at least the texts in which it is near some entity. Common words are out by that alone.
    near = entities.select("key", F.explode("terms").alias("near_term")).distinct().groupBy("near_term").agg(F.count(F.lit(1)).alias("n_near"))
    pairs = cut(pairs.join(near, F.col("term") == F.col("near_term")).where(share("n_near") >= GENERALISE).drop("near_term"))
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(_key(F.col("text")).alias("key"), "text")
    terms = F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")
    # A text that repeats counts once: each of its rows counts for its part. Sums by term are made before anything moves.
    copies = cut(found.groupBy(F.col("key").alias("copied")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    once = rows.join(small_side(copies, 40, HELD_BYTES), F.col("key") == F.col("copied"), "left")
    per_term = once.select(F.coalesce(1 / F.col("copies"), F.lit(1.0)).alias("part"), terms).groupBy("term").agg(F.round(F.sum("part")).alias("n_term"))
    best = pairs.join(per_term, "term").groupBy("term").agg(F.max(share("n_term")).alias("disclosure")).where(F.col("disclosure") >= GENERALISE)
    action = F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise")
    flagged = cut(best.withColumn("action", action))
    return flagged, cut(rows.select("key", terms).join(small_side(flagged.select("term"), F.lit(64) + F.octet_length("term"), HELD_BYTES), "term", "left_semi").distinct())


def _term_spans(docs: DataFrame, flagged: DataFrame, places: DataFrame) -> DataFrame:
    """Spans of flagged terms by text: ``key``, ``terms`` (start, end, action)."""
    wanted = places.join(small_side(flagged, F.lit(96) + F.octet_length("term"), HELD_BYTES), "term").groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("actions")
    )
    wanted = cut(wanted)
    wanted_bytes = F.lit(64) + F.size("actions") * 64 + F.octet_length(F.array_join(F.map_keys("actions"), ""))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", _key(F.col("text")))
    some = texts.join(small_side(wanted, wanted_bytes, HELD_BYTES), F.col("text_key") == F.col("key"))
    words = F.array_join(F.sort_array(F.map_keys("actions")), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), words, F.lit(r")(?!\p{L})"))
    spans = _spans(F.col("text"), pattern)
    spans = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.element_at(F.col("actions"), F.lower(x["value"])).alias("action")))
    return some.select("key", spans.alias("terms")).groupBy("key").agg(F.first("terms").alias("terms"))


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``key`` (of the text), an array of spans (``start``,
    ``end``; code points, end exclusive) for each kind, and ``terms`` (with ``action``).

    * Matches of a kind are leftmost and do not overlap; those that fail their check
      (parts of an address, digits, Luhn) are dropped without another try. Kinds may overlap.
    * Revealing terms are spans of their own, where they lie in no span of personal data.
    * A NULL or empty text has no spans. Statistics count different texts, so copies and
      repeated rows change nothing. Ids may be NULL or repeat. Other columns are ignored.
      An empty table gives an empty result.
    """
    found = cut(_found(docs))
    flagged, places = revealing_terms(found, docs)
    spans = cut(_term_spans(docs, flagged, places)).withColumnRenamed("key", "span_key")
    joined = found.join(small_side(spans, F.lit(64) + F.size("terms") * 64, HELD_BYTES), F.col("key") == F.col("span_key"), "left")
    all_base = F.concat(*KINDS)
    terms = F.coalesce("terms", F.array().cast("array<struct<start: int, end: int, action: string>>"))
    clear = F.filter(terms, lambda t: ~F.exists(all_base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return joined.select("doc_id", "key", *KINDS, clear.alias("terms"))


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["start"], x["end"]))


def digest(detected: DataFrame) -> DataFrame:
    """Counts, the base spans' hash and all spans as text, from what ``detect`` returns."""
    base = F.concat(*[_listed(k, F.col(k)) for k in KINDS])
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    spans = F.array_join(F.concat(base, _listed(TERM, F.col("terms"))), ",")
    return detected.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), spans.alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with personal data as ``[EMAIL]`` and so on, revealing terms as ``[TERM]`` or left out.

    Of overlapping spans the first gives the label and all of them go. See ``detect`` for the rest.
    """
    by_text = detect(docs).groupBy("key").agg(*[F.first(k).alias(k) for k in (*KINDS, "terms")]).withColumnRenamed("key", "span_key")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", _key(F.col("text")))
    rows = rows.join(by_text, F.col("key") == F.col("span_key"))

    def labelled(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("label")))

    terms = F.transform(F.col("terms"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.when(x["action"] == "remove", "").otherwise("[TERM]").alias("label")))
    spans = F.array_sort(reduce(lambda a, b: F.concat(a, b), [labelled(k) for k in KINDS] + [terms]))

    def step(acc: Column, x: Column) -> Column:
        apart = x["start"] >= acc["at"]
        between = F.substring(F.col("text"), acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        out = F.when(apart, F.concat(acc["out"], between, x["label"])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return rows.select("doc_id", text.alias("text"))
