"""Regulator filings: index arrays, archive addresses and the offering document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from capledger.functions.numbers import number_from_text, unpadded_cik
from capledger.schema import FILINGS_INDEX

# Fixed values.
ARCHIVE_ROOT = "https://www.sec.gov/Archives/edgar/data/"
ARCHIVE_DOCUMENT = "primary_doc.xml"
OFFERING_NAMESPACE = "http://www.sec.gov/edgar/document/thirtypartyfiler/formsubmission"


def archive_url(cik: Column, accession: Column) -> Column:
    return F.concat(
        F.lit(ARCHIVE_ROOT), unpadded_cik(cik).cast("string"), F.lit("/"),
        F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), F.lit(ARCHIVE_DOCUMENT),
    )


def index_rows(index_json: Column) -> Column:
    """The parallel arrays of a filings index as array<struct>; short arrays pad with null."""
    recent = F.from_json(index_json, FILINGS_INDEX)["filings"]["recent"]
    nothing = F.array().cast("array<string>")
    return F.arrays_zip(
        F.coalesce(recent["form"], nothing).alias("form"),
        F.coalesce(recent["filingDate"], nothing).alias("filing_date"),
        F.coalesce(recent["accessionNumber"], nothing).alias("accession_number"),
    )


# Comments, processing instructions and the document type say nothing; character data counts where it needs no escape.
_UNSPOKEN = r"(?s)<(?:!--.*?-->|\?.*?\?>|!DOCTYPE(?:[^<>\[]|\[.*?\]\s*(?=>))*>)"
_PLAIN_DATA, _OTHER_DATA = r"<!\[CDATA\[([^<&\]]*)\]\]>", r"(?s)<!\[CDATA\[.*?\]\]>"
_TAG = r"""<(?:[^<>"']++|"[^"]*+"|'[^']*+')++>"""
_DECLARED = r"""\sxmlns(?::([^\s=]+))?\s*=\s*(?:"([^"]*)"|'([^']*)')"""
_ATTRIBUTE = r"""\s([^\s=:]+):[^\s=]+\s*=\s*["']"""

_OFFERING_TAGS = ("offeringData", "totalOfferingAmount")
_BINDINGS = "array<struct<depth: int, prefix: string, uri: string>>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named there: a one-element transform binds it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _tags(document: Column) -> Column:
    """The tags of a document in order, each with the text up to the next one."""
    spoken = F.when(
        F.contains(document, F.lit("<!")) | F.contains(document, F.lit("<?")), F.regexp_replace(document, _UNSPOKEN, "")
    ).otherwise(document)
    plain = _once(spoken, lambda d: F.when(
        F.contains(d, F.lit("<![CDATA[")), F.regexp_replace(F.regexp_replace(d, _PLAIN_DATA, "$1"), _OTHER_DATA, "?")
    ).otherwise(d))

    def declared(tag: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(tag, F.lit(_DECLARED), F.lit(0)),
            lambda d: F.struct(
                F.regexp_extract(d, _DECLARED, 1).alias("prefix"),
                F.concat(F.regexp_extract(d, _DECLARED, 2), F.regexp_extract(d, _DECLARED, 3)).alias("uri"),
            ),
        )

    def used(tag: Column) -> Column:
        # Values are taken out, so that what looks like an attribute inside one is none.
        bare = F.regexp_replace(tag, r"""=\s*("[^"]*"|'[^']*')""", "=''")
        return F.filter(F.regexp_extract_all(bare, F.lit(_ATTRIBUTE), F.lit(1)), lambda p: ~p.isin("xmlns", "xml"))

    def read(tag: Column, text: Column, name: Column) -> Column:
        # Most tags have no attribute.
        with_values, prefixed, local = F.contains(tag, F.lit("=")), F.contains(name, F.lit(":")), F.substring_index(name, ":", -1)
        return F.struct(
            F.startswith(tag, F.lit("</")).alias("closes"), F.endswith(tag, F.lit("/>")).alias("empty"),
            (~with_values & ~prefixed & ~name.isin(*_OFFERING_TAGS)).alias("quiet"),
            F.when(prefixed, F.substring_index(name, ":", 1)).otherwise("").alias("prefix"), local.alias("local"),
            F.when(with_values, declared(tag)).otherwise(F.array().cast("array<struct<prefix: string, uri: string>>")).alias("declared"),
            F.when(with_values, used(tag)).otherwise(F.array().cast("array<string>")).alias("used"),
            text.alias("text"),
        )

    def with_text(document: Column) -> Column:
        parts = [F.regexp_extract_all(document, F.lit(f"({_TAG})([^<]*+)"), F.lit(i)).alias(n) for i, n in ((1, "tag"), (2, "text"))]
        return F.arrays_zip(*parts)

    return F.transform(
        _once(plain, with_text),
        lambda t: _once(F.regexp_extract(t["tag"], r"^</?([^\s/>]+)", 1), lambda name: read(t["tag"], t["text"], name)),
    )


def _walk(tags: Column) -> Column:
    """``struct<found, amount, bad, …>`` after all tags: a fold with the depth and the prefixes bound at it.

    ``at`` is the depth of the first offering data: 0 before it, -1 behind it.
    """
    nothing = F.struct(
        F.lit(0).alias("depth"), F.array().cast(_BINDINGS).alias("bindings"), F.lit(0).alias("at"), F.lit(False).alias("taken"),
        F.lit(None).cast("string").alias("amount"), F.lit(False).alias("bad"),
    )

    def bound(bindings: Column, prefix: Column) -> Column:
        return F.try_element_at(F.filter(bindings, lambda b: b["prefix"] == prefix), F.lit(-1))["uri"]

    def opened(state: Column, tag: Column) -> Column:
        depth = state["depth"] + 1
        bindings = F.when(F.size(tag["declared"]) == 0, state["bindings"]).otherwise(F.concat(
            state["bindings"],
            F.transform(tag["declared"], lambda d: F.struct(depth.alias("depth"), d["prefix"].alias("prefix"), d["uri"].alias("uri"))),
        ).cast(_BINDINGS))

        def entered(bindings: Column, uri: Column) -> Column:
            own = F.coalesce(uri == OFFERING_NAMESPACE, F.lit(False))
            starts = (state["at"] == 0) & (tag["local"] == _OFFERING_TAGS[0]) & own & (depth > 1)
            takes = (state["at"] > 0) & ~state["taken"] & (tag["local"] == _OFFERING_TAGS[1]) & own
            unbound = ((tag["prefix"] != "") & (tag["prefix"] != "xml") & (F.coalesce(uri, F.lit("")) == "")) | F.exists(
                tag["used"], lambda p: F.coalesce(bound(bindings, p), F.lit("")) == ""
            )
            return F.struct(
                F.when(tag["empty"], state["depth"]).otherwise(depth).alias("depth"),
                F.when(tag["empty"], state["bindings"]).otherwise(bindings).alias("bindings"),
                F.when(starts, F.when(tag["empty"], -1).otherwise(depth)).otherwise(state["at"]).alias("at"),
                (state["taken"] | takes).alias("taken"),
                F.when(takes, F.when(~tag["empty"], tag["text"])).otherwise(state["amount"]).alias("amount"),
                (state["bad"] | unbound).alias("bad"),
            )

        return _once(bindings, lambda held: _once(bound(held, tag["prefix"]), lambda uri: entered(held, uri)))

    def closed(state: Column) -> Column:
        return F.struct(
            (state["depth"] - 1).alias("depth"),
            F.filter(state["bindings"], lambda b: b["depth"] < state["depth"]).alias("bindings"),
            F.when(state["at"] == state["depth"], -1).otherwise(state["at"]).alias("at"),
            state["taken"].alias("taken"), state["amount"].alias("amount"), state["bad"].alias("bad"),
        )

    def passed(state: Column) -> Column:
        return F.struct((state["depth"] + 1).alias("depth"), *[state[f].alias(f) for f in ("bindings", "at", "taken", "amount", "bad")])

    # Tags without prefix, attribute and an offering's name say nothing but how deep the next ones stand.
    return F.aggregate(tags, nothing, lambda state, tag: (
        F.when(tag["closes"], closed(state)).when(tag["quiet"], F.when(tag["empty"], state).otherwise(passed(state)))
        .otherwise(opened(state, tag))
    ))


def offering(document: Column) -> Column:
    """``struct<is_offering, amount>`` of an offering document.

    Offering data is looked for at any depth below the root and the amount at any depth inside the first of them, both
    by the namespace their prefix is bound to where they stand. ``is_offering`` is false for malformed XML, prefixes
    that are not bound, or a document without offering data. A missing or unreadable amount is null; the amount's text ends
    at a tag inside it.
    """
    # The parser tells whether a document is well-formed, once; documents that cannot hold offering data are not walked.
    parsed = F.from_xml(document, "offeringData STRING, _corrupt_record STRING", {"ignoreNamespace": "true"})
    may_hold = F.contains(document, F.lit("offeringData")) & F.contains(document, F.lit(OFFERING_NAMESPACE))

    def holds(walked: Column) -> Column:
        return F.coalesce((walked["at"] != 0) & ~walked["bad"] & parsed["_corrupt_record"].isNull(), F.lit(False))

    def read(walked: Column, found: Column) -> Column:
        return F.struct(
            found.alias("is_offering"), F.when(found, number_from_text(walked["amount"])).alias("amount")
        )

    walk = F.when(may_hold, _walk(_tags(document)))
    return _once(walk, lambda walked: _once(holds(walked), lambda found: read(walked, found)))
