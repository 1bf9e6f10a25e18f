"""I-Match fingerprints with randomised lexicons, with built-in functions only.

The lexicon holds the terms (lower-case words) whose document frequency lies in a band: rarer than ``most`` of all documents
and in ``fewest`` of them at least, counted over all words of all texts. Of a document, the distinct terms of the lexicon are sorted and hashed, once for each of
several random sub-lexicons. Sub-lexicons come in densities, each half of the one before: dense ones tell alike documents
apart, sparse ones still agree when part of a long text changes. A text of more than ``SHORT`` distinct words only
shows the ``THIN`` th part of the lexicon that all sub-lexicons for long texts are drawn from, so no other term of it is
ever moved. The likeness of two fingerprints is the largest share, over densities, of sub-lexicons on which they agree.

Equal texts have equal fingerprints. Texts with fewer than ``FEW`` terms of the lexicon (all their
words are too common, as in a large group of copies, or too rare) are compared by their ``SPARE`` words of smallest hashes too;
a text without any such word has a hash of its words as fingerprint. Null texts count as
empty. Documents are in order of id, null ids last; equal ids in order of the rows as they are read. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import Scratch
from .common import BLANKS

#: Sub-lexicons of each density, densities for long and for short texts.
DRAWS, LONG, BRIEF = 6, 7, 4
SHORT, THIN = 128, 8
#: Texts with fewer terms of the lexicon also count words outside it: so many, in so many densities.
FEW, SPARE, SPARE_DENSITIES = 4, 16, 5
#: Ids per bucket when documents are put in order, and rows a broadcast may have.
IDS, BROADCAST_ROWS = 128, 200_000


def word_numbers(text: Column) -> Column:
    """Distinct words as sorted 64-bit hashes."""
    words = F.filter(F.split(F.lower(text), f"[{BLANKS}]+"), lambda w: w != "")
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def shown(numbers: Column) -> Column:
    """The words that may take part in a fingerprint: all of a short text, a fixed share of the lexicon otherwise."""
    return F.when(F.size(numbers) <= SHORT, numbers).otherwise(F.filter(numbers, lambda h: h.bitwiseAND(THIN - 1) == 0))


def _following(keys: DataFrame, key: str) -> DataFrame:
    """``key`` and ``after``, the next larger one (null for the last), of distinct whole numbers; no task sees them all."""
    wide = 4096
    coarse = keys.select(key, F.floor(F.col(key) / wide).alias("_c"))
    inner = coarse.withColumn("_next", F.lead(key).over(Window.partitionBy("_c").orderBy(key)))
    first = coarse.groupBy("_c").agg(F.min(key).alias("_first"))
    # One row for every 4096 buckets, so for half a million ids.
    jump = first.select("_c", F.lead("_first").over(Window.orderBy("_c")).alias("_jump"))
    return inner.join(jump, "_c").select(key, F.coalesce("_next", "_jump").alias("after"))


def with_next(docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``uid, id, text, next_uid, next_text``: every document with the next one by id, the last with the first."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col(id_column) / IDS), F.lit((1 << 62) // IDS)).alias("bucket"),
    )
    firsts = rows.groupBy("bucket").agg(F.min(F.struct(F.col("id"), F.col("uid"))).alias("first")).select("bucket", F.col("first.uid").alias("uid"))
    firsts = scratch.store(firsts, "firsts")
    least = firsts.agg(F.min("bucket").alias("least"), F.count("*").alias("n")).first()
    links = _following(firsts.select("bucket"), "bucket").select(F.col("bucket").alias("before"), F.coalesce("after", F.lit(least["least"])).alias("bucket"))
    wanted = scratch.store(firsts.join(links, "bucket").select("uid", "before"), "heads")
    heads = rows.select("uid", "text").join(F.broadcast(wanted) if least["n"] <= BROADCAST_ROWS else wanted, "uid")
    heads = heads.select(F.col("before").alias("bucket"), F.col("uid").alias("head_uid"), F.col("text").alias("head"))
    line = Window.partitionBy("bucket").orderBy("id", "uid")
    placed = rows.withColumns({"next_uid": F.lead("uid").over(line), "next_text": F.lead("text").over(line)})
    joined = placed.join(heads.hint("merge"), "bucket", "left")
    last = F.col("next_uid").isNull()
    return joined.select("uid", "id", "text", F.coalesce("next_uid", "head_uid").alias("next_uid"), F.when(last, F.col("head")).otherwise(F.col("next_text")).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the characters replaced by as many of the next text's first ones, or all it has."""
    size = F.length(text)
    quarter = F.floor(size / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - quarter), F.substring(following, F.lit(1), quarter))


def _drawn(terms: Column, densities: int, offset: int) -> Column:
    """One number per random sub-lexicon and density, null where ``terms`` hold none of it."""
    masks = F.array(*(F.lit((1 << d) - 1).cast("bigint") for d in range(densities)))

    def number(i: Column) -> Column:
        draw, mask = i % DRAWS + offset, F.element_at(masks, (F.floor(i / DRAWS) + 1).cast("int"))
        chosen = F.filter(F.transform(terms, lambda h: F.xxhash64(h, draw)), lambda h: h.bitwiseAND(mask) == 0)
        return F.when(F.size(chosen) > 0, F.xxhash64(chosen).bitwiseAND(0x7FFFFFFF).cast("int"))

    return F.transform(F.sequence(F.lit(0), F.lit(densities * DRAWS - 1)), number)


def _parts(terms: Column, short: Column) -> Column:
    thin = F.filter(terms, lambda h: h.bitwiseAND(THIN - 1) == 0)
    return F.concat(_drawn(thin, LONG, 0), _drawn(F.when(short, terms).otherwise(F.slice(terms, 1, 0)), BRIEF, DRAWS))


def likeness(a: Column, b: Column, densities: int = LONG + BRIEF) -> Column:
    """Largest share over densities of sub-lexicons that agree, among those that show terms of either text."""
    both = F.zip_with(a, b, lambda x, y: F.when(x == y, 1).when(x.isNotNull() | y.isNotNull(), 0))  # null: shown by neither
    count = lambda part, wanted: F.size(F.filter(part, wanted))

    def share(i: Column) -> Column:
        part = F.slice(both, i * DRAWS + 1, F.lit(DRAWS))
        return count(part, lambda x: x == 1) / F.greatest(count(part, lambda x: x.isNotNull()), F.lit(DRAWS // 2))

    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(densities - 1)), share))


def frequencies(docs: DataFrame, fewest: int = 2, text_column: str = "text") -> DataFrame:
    """``h, n``: the words of whole texts, as numbers, with the documents that hold them, from ``fewest`` on."""
    words = docs.select(F.explode(word_numbers(F.col(text_column))).alias("h"))
    return words.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= fewest)


def fingerprints(docs: DataFrame, fewest: int = 2, most: float = 0.02, id_column: str = "doc_id", text_column: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every document."""
    scratch = scratch or Scratch(docs.sparkSession)
    pairs = with_next(docs, scratch, id_column, text_column).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    pairs = pairs.select("uid", "next_uid", "id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), word_numbers(F.col("text")).alias("own"), word_numbers(F.col("edited")).alias("other"))
    bag = lambda name: F.xxhash64(name).alias(f"{name}_bag")
    spare = lambda name: F.slice(name, 1, SPARE).alias(f"{name}_spare")
    short = lambda name: (F.size(name) <= SHORT).alias(f"{name}_short")
    texts = pairs.select("uid", "next_uid", "id", "n_chars", "edited_sha256", bag("own"), bag("other"), spare("own"), spare("other"), short("own"), short("other"), shown(F.col("own")).alias("own"), shown(F.col("other")).alias("other"))
    texts = scratch.store(texts, "texts")

    documents = texts.count()
    largest = max(fewest, int(most * documents))
    counts = scratch.store(frequencies(docs, fewest, text_column), "counts")
    # A document has few words, so at most its words / ``most`` terms are frequent in all: bounded whatever the data's size.
    frequent = counts.where(F.col("n") > largest).select("h")
    band = counts.where(F.col("n") <= largest).select("h")
    shown_terms = texts.select("uid", F.lit(True).alias("is_own"), F.explode("own").alias("h")).unionByName(texts.select("uid", F.lit(False).alias("is_own"), F.explode("other").alias("h")))
    kept = shown_terms.join(F.broadcast(frequent), "h", "left_anti").join(band, "h")
    gathered = kept.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_own"), F.col("h")))).alias("own_terms"), F.array_sort(F.collect_list(F.when(~F.col("is_own"), F.col("h")))).alias("other_terms")
    )
    joined = texts.drop("own", "other").join(gathered, "uid", "left")
    made = joined
    for name in ("own", "other"):
        terms = F.coalesce(f"{name}_terms", F.array().cast("array<bigint>"))
        made = made.withColumns({f"{name}_parts": _parts(terms, F.col(f"{name}_short")), f"{name}_few": F.size(terms) < FEW, f"{name}_spare": _drawn(F.col(f"{name}_spare"), SPARE_DENSITIES, 2 * DRAWS)})
    kinds = ("parts", "spare", "few", "bag")
    made = made.select("uid", "next_uid", "id", "n_chars", "edited_sha256", *(f"{name}_{kind}" for name in ("own", "other") for kind in kinds))
    made = scratch.store(made, "parts")

    following = made.select(F.col("uid").alias("next_uid"), *(F.col(f"own_{kind}").alias(f"next_{kind}") for kind in kinds))
    final = made.join(following, "next_uid")
    every = lambda name: F.concat(f"{name}_parts", f"{name}_spare")
    empty = lambda name: F.forall(every(name), lambda x: x.isNull())
    written = lambda name: F.when(empty(name), F.concat(F.lit("words "), F.hex(f"{name}_bag"))).otherwise(
        F.array_join(F.transform(every(name), lambda x: F.coalesce(x.cast("string"), F.lit(""))), ",")
    )

    def alike(name: str) -> Column:
        usual = likeness(F.col("own_parts"), F.col(f"{name}_parts"))
        spare = likeness(F.col("own_spare"), F.col(f"{name}_spare"), SPARE_DENSITIES)
        some = F.when(F.col("own_few") | F.col(f"{name}_few"), F.greatest(usual, spare)).otherwise(usual)
        whole = F.when(empty("own"), F.col("own_bag") == F.col(f"{name}_bag")).otherwise(every("own") == every(name))
        return F.when(whole, 1.0).otherwise(some)

    return final.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256", written("own").alias("fingerprint"), written("other").alias("edited_fingerprint"),
        alike("other").alias("near_edited"), alike("next").alias("near_next"),
    )
