"""Company names to directory entries, by containment either way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from capledger.functions.numbers import padded_cik

#: Texts are compared through pieces of so many characters.
GRAM = 3


def _grams(text: Column, n: int) -> Column:
    """The distinct pieces of ``n`` characters; none of a shorter text."""
    places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1)))
    return F.array_distinct(F.transform(places, lambda at: F.substring(text, at, F.lit(n))))


def rarest_grams(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(part, gram, n): of each wanted text the gram that the fewest texts hold, and how many do.

    Only grams of wanted texts are counted. A wanted text with a gram that no text holds is left out.
    """
    own = wanted.select("part", F.explode(_grams(F.col("part"), GRAM)).alias("gram"))
    held = texts.select(F.explode(_grams(F.col("text"), GRAM)).alias("gram"))
    counts = held.join(own.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest")
    return own.join(counts, "gram", "left").groupBy("part").agg(rarest).select(
        "part", "rarest.gram", "rarest.n"
    ).where(F.col("n") > 0)


def _parts_found_in(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(payload of ``texts``, part): every distinct ``wanted`` text occurring inside a text.

    ``wanted`` is (part), distinct and not empty. A text meets a wanted one only where it holds that one's rarest
    gram, and is then searched for the whole of it; wanted texts shorter than a gram are met by equality. Both joins
    shuffle: their exploded sides are never broadcast.
    """
    payload = [c for c in texts.columns if c != "text"]
    pieces = F.concat(*[F.coalesce(_grams(F.col("text"), n), F.array().cast("array<string>")) for n in range(1, GRAM)])
    short = texts.select(*payload, F.explode(pieces).alias("part")).hint("merge").join(
        wanted.where(F.length("part") < GRAM), "part"
    )
    longer = wanted.where(F.length("part") >= GRAM)
    index = rarest_grams(texts, longer).select("part", "gram")
    grams = texts.select(*payload, "text", F.explode(_grams(F.col("text"), GRAM)).alias("gram"))
    found = grams.hint("merge").join(index, "gram").where(F.contains("text", "part"))
    return found.select(*payload, "part").unionByName(short.select(*payload, "part"))


def _first(entry: str = "entry") -> Column:
    """The entry of lowest ordinal (the ordinal leads the struct)."""
    return F.min(entry).alias("entry")


def resolve_companies(companies: DataFrame, directory: DataFrame) -> DataFrame:
    """(id, name, cik, official_name): the first directory entry that matches each company.

    An entry matches when its lower-cased title contains the lower-cased name or the other way
    round; of several, the one of lowest ordinal is taken. Companies without a match have nulls.
    Names and titles meet through an index of rare pieces, so the work grows with the texts and
    with how many hold the rarest piece of a wanted one, never with names x titles.
    """
    entries = directory.select(
        F.lower("title").alias("text"), F.struct("ordinal", "cik", "title").alias("entry")
    ).where(F.col("text").isNotNull())
    titles = entries.groupBy("text").agg(_first())
    names = companies.select(F.lower("name").alias("text")).where(F.col("text").isNotNull()).distinct()

    # Titles that hold a name: best entry per name.
    wanted_names = names.where(F.col("text") != "").select(F.col("text").alias("part"))
    in_titles = (
        _parts_found_in(titles, wanted_names)
        .groupBy("part").agg(_first())
        .join(wanted_names, "part", "left_semi")
        .select(F.col("part").alias("name_text"), "entry")
    )
    # Names that hold a title: best entry per name.
    wanted_titles = titles.where(F.col("text") != "").select(F.col("text").alias("part"), "entry")
    in_names = (
        _parts_found_in(
            names.select("text", F.col("text").alias("name_text")), wanted_titles.select("part")
        )
        .join(wanted_titles, "part")
        .select("name_text", "entry")
    )
    found = in_titles.unionByName(in_names).groupBy("name_text").agg(_first())

    # Empty text is contained in everything: one entry each, as scalars.
    any_entry = entries.agg(F.min("entry")).scalar()
    untitled = entries.where(F.col("text") == "").agg(F.min("entry")).scalar()
    key = F.lower("name")
    return (
        companies.withColumn("name_text", key)
        .join(found, "name_text", "left")
        .withColumn("empty_title", untitled)
        .withColumn("entry", F.when(F.col("name_text") == "", any_entry).otherwise(
            F.when(F.col("name_text").isNotNull(), F.least("entry", "empty_title"))
        ))
        .select(
            "id", "name",
            padded_cik(F.col("entry.cik")).alias("cik"),
            F.col("entry.title").alias("official_name"),
        )
    )
