"""SpotSigs fingerprints of documents, on built-in functions alone.

A signature is a common word (the anchor) with the next content words after it;
a fingerprint is the set of a text's signatures. Text around the content, where
anchors are rare, hardly counts. Here a document is compared with an edit and
with its next one; :mod:`lakeweir.llm.spotjoin` joins a whole corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweir.llm.common import numbered, saved

#: Common words of English, German, French and Spanish.
ANCHORS = {
    "en": "a an and are as at be by for from had has have he in is it not of on or that the this to was were which with",
    "de": "als auch auf aus bei das dem den der des die ein eine er es für ist mit nicht sich sie sind und von war wird zu",
    "fr": "au aux avec ce dans des du elle en est et il la le les mais ne ou par pas plus pour que qui sur une",
    "es": "al como con cuando del el ella era esta fue las los lo más muy no para pero por se sin son su una y",
}
#: Content words in a chain.
CHAIN = 2
#: Ids in one sorted run.
RUN_IDS = 1000
#: Borders between cells of neighbouring runs.
MOST_CELLS = 1000


def _anchor_words() -> str:
    return "|".join(sorted({w for words in ANCHORS.values() for w in words.split()}))


def with_signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """``df`` with the sorted distinct signatures of a text, as 64-bit hashes, in the column ``out``.

    Words are lower-cased runs of letters and digits. A text in which no anchor
    has a whole chain after it is signed by its runs of ``chain + 1`` words (all
    words, if fewer), and one without words by its characters. Null and empty
    texts have none. Each step is a column, so that none is computed twice.
    """
    # Possessive: an anchor never is a content word, and runs of anchors can be long.
    content = r"(?: ~[^ ]+)*+ [^~ ][^ ]*+"
    plain, marked, chains, words = (f"__{out}_{part}" for part in ("plain", "marked", "chains", "words"))
    none = F.array().cast("array<long>")
    df = df.withColumn(plain, F.concat(F.lit(" "), F.trim(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))), F.lit(" ")))
    df = df.withColumn(marked, F.regexp_replace(plain, f" (?=(?:{_anchor_words()}) )", " ~"))
    # An anchor that follows itself has the same chain: one of them is enough.
    df = df.withColumn(marked, F.regexp_replace(marked, r"( ~[^ ]++)(?:\1)++(?= )", "$1"))
    spots = F.regexp_extract_all(marked, F.lit(f"(?= (~[^ ]+{content * chain}) )"), F.lit(1))
    df = df.withColumn(chains, F.transform(spots, lambda s: F.xxhash64(F.regexp_replace(s, " ~[^ ]+", ""))))
    df = df.withColumn(words, F.when(F.size(chains) == 0, F.filter(F.split(plain, " "), lambda w: w != "")))
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - chain))
    runs = F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(words, i, chain + 1), " "), F.lit(1)))
    signs = (
        F.when(F.coalesce(F.col(text), F.lit("")) == "", none)
        .when(F.size(chains) > 0, F.col(chains))
        .when(F.size(words) > 0, runs)
        .otherwise(F.array(F.xxhash64(text, F.lit(2))))
    )
    return df.withColumn(out, F.array_sort(F.array_distinct(signs))).drop(plain, marked, chains, words)


def fingerprint(signs: Column) -> Column:
    """A set of signatures as text: 16 hex digits each."""
    return F.array_join(F.transform(signs, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of signatures; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def with_next(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, next_text)``: each document with the text of the next one.

    Documents stand in descending order of id, null ids last, those of one id by
    a hash of their text; the next of the last is the first. Ids are dealt into
    runs of neighbouring ids, and the head of each run is also the guest at the
    end of the run before. Texts move once. Ids are of any type that sorts.
    """
    named = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = numbered(named.select("doc_id").distinct(), [F.col("doc_id").desc_nulls_last()], "place")
    runs = ids.groupBy(F.expr(f"place div {RUN_IDS}").alias("run")).agg(
        F.max("doc_id").alias("high"), F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("has_null")
    )
    runs = saved(runs, "runs")
    n_runs = max(1, runs.count())
    # Every so many runs a border: as many cells at most, and as full, however the ids lie.
    borders = runs.where(f"low IS NOT NULL AND run % {-(-n_runs // MOST_CELLS)} = 0").select("low").collect()
    borders = F.array(*[F.lit(r["low"]) for r in borders]).cast(f"array<{docs.schema['doc_id'].dataType.simpleString()}>")

    def cell(of: str) -> Column:
        return F.when(F.col(of).isNotNull(), F.size(F.filter(borders, lambda b: b <= F.col(of))))

    # A run covers the cells from its lowest to its highest id; null ids have a cell of their own.
    cells = F.coalesce(F.sequence(cell("low"), cell("high")), F.array().cast("array<int>"))
    null_cell = F.when(F.col("has_null"), F.array(F.lit(None).cast("int"))).otherwise(F.array().cast("array<int>"))
    runs = runs.select("run", "low", "high", F.explode(F.concat(cells, null_cell)).alias("cell"))
    placed = named.withColumn("at", cell("doc_id")).join(
        runs, F.col("at").eqNullSafe(F.col("cell")) & (F.col("doc_id").isNull() | F.col("doc_id").between(F.col("low"), F.col("high")))
    )
    is_head = F.coalesce(F.col("doc_id") == F.col("high"), F.col("high").isNull())
    before = F.pmod(F.col("run") - 1, F.lit(n_runs))
    seats = F.array(F.struct(F.col("run").alias("run"), F.lit(False).alias("guest")))
    guests = F.array(F.struct(before.alias("run"), F.lit(True).alias("guest")))
    seated = placed.select("doc_id", "text", F.explode(F.when(is_head, F.concat(seats, guests)).otherwise(seats)).alias("seat"))
    return seated.select("doc_id", "text", "seat.run", "seat.guest")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each document, and how it compares with an edit and with the next document.

    Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``. The edited text has its last ``floor(n_chars / 2)``
    characters replaced by the first as many of the next document (see
    :func:`with_next`), or all of it if that has fewer.

    A null text counts as the empty one, whose fingerprint is empty. Each row
    has a result; repeated rows are neighbours. Other columns are not read.
    """
    order = Window.partitionBy("run").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    rows = with_next(docs).withColumn("next_text", F.lead("text").over(order))
    rows = with_signatures(rows, "text", "signs").withColumn("next_signs", F.lead("signs").over(order))
    rows = rows.where("NOT guest")
    n_chars = F.char_length("text").cast("long")
    edited = F.expr("concat(substring(text, 1, char_length(text) - char_length(text) div 2), substring(next_text, 1, cast(char_length(text) div 2 AS INT)))")
    rows = rows.select("doc_id", n_chars.alias("n_chars"), edited.alias("edited"), "signs", "next_signs")
    rows = with_signatures(rows, "edited", "edited_signs")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("signs")).alias("fingerprint"),
        fingerprint(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
    )
