"""Fill-in-middle by an escaped delimiter.

A text is cut into units (runs of A-Z and a-z, or single other characters). The delimiter's own occurrences are escaped first, so
regexp_replace can append it after each unit; the number of delimiters is the number of units, and substring_index takes the units before, between and
after two ranks out. The three parts are unescaped and put together with their markers. Everything is a DataFrame expression over one row: no
shuffle, no Python, one pass over the table.

Defined results: null and empty texts have no units and stay plain, as do texts that hold a marker of their own (they could not be taken apart again) and
a tenth of the others. Draws depend on the seed and doc_id alone (null: the word null), so repeated rows get equal results and reruns agree.
Parts may be empty. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Markers, and the shares of a hundred that stay plain from PLAIN_FROM on and take the suffix first below SPM_BELOW.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
SEED = "1"
#: The delimiter, and the character that escapes it and itself when a digit follows.
MARK, ESCAPE = "\x01", "\x02"
#: One unit of an escaped text: an escaped character is one unit, as it was before.
UNIT = f"[A-Za-z]+|{ESCAPE}[01]|[^A-Za-z]"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0")), F.lit(MARK), F.lit(ESCAPE + "1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE + "1"), F.lit(MARK)), F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def draws(key: Column, seed: str = SEED) -> list[Column]:
    """The first four groups of eight hexadecimal digits of the SHA-256 of `seed:key`, as numbers."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def units(marked: Column, count: Column) -> Column:
    """The first `count` units of a marked text, or the last ones if it is negative; none for 0."""
    return F.call_function("substring_index", marked, F.lit(MARK), count)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED) -> DataFrame:
    """key, n (units), form (plain, psm or spm), prefix, middle, suffix (null if plain), output."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), whole.alias("_text"), F.array(*draws(F.col(key), seed)).alias("_h"))
    rows = rows.withColumn("_marked", F.regexp_replace(escape(F.col("_text")), f"({UNIT})", f"$1{MARK}"))
    rows = rows.withColumn("n", (F.length("_marked") - F.length(F.replace(F.col("_marked"), F.lit(MARK), F.lit("")))).cast("long"))
    own = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        own = own | F.contains(F.col("_text"), F.lit(marker))
    plain = (F.col("_text") == "") | own | (F.col("_h")[2] % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(F.col("_h")[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    cut = [F.col("_h")[i] % (F.col("n") + 1) for i in (0, 1)]
    rows = rows.withColumns({"form": form, "_from": F.least(*cut).cast("int"), "_to": F.greatest(*cut).cast("int")})
    part = {
        "prefix": units(F.col("_marked"), F.col("_from")),
        "middle": units(units(F.col("_marked"), F.col("_to")), F.col("_from") - F.col("_to")),
        # The text ends with a delimiter, so one more from the right.
        "suffix": units(F.col("_marked"), (F.col("_to") - F.col("n") - 1).cast("int")),
    }
    split = F.col("form") != "plain"
    rows = rows.withColumns({c: F.when(split, unescape(F.replace(x, F.lit(MARK), F.lit("")))) for c, x in part.items()})
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("_text"))
    return rows.select(F.col("_key").alias(key), "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output of transform() was made of, from the output and its form alone."""
    body = F.substring(output, len(PREFIX) + 1, 1 << 30)
    middle = F.substring_index(body, MIDDLE, -1)
    head = F.substring_index(body, MIDDLE, 1)

    def both(marker: str) -> tuple[Column, Column]:
        return F.substring_index(head, marker, 1), F.substring_index(head, marker, -1)

    prefix, suffix = both(SUFFIX)
    suffix_first, prefix_after = both(PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix_after, middle, suffix_first)).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every whole text."""
    made = transform(docs)
    back = restore(F.col("output"), F.col("form"))
    return made.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
