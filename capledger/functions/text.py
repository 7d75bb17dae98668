"""String predicates, trimming, masking and URL parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def has_text(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def has_number(c: Column) -> Column:
    """Neither null nor zero."""
    return F.coalesce(c != 0, F.lit(False))


def text_or_null(c: Column) -> Column:
    """Empty text becomes null."""
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (plain ``trim`` removes only spaces)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def contains_either_way(a: Column, b: Column) -> Column:
    """Case-insensitive containment of one text in the other."""
    la, lb = F.lower(a), F.lower(b)
    return F.coalesce(F.contains(la, lb) | F.contains(lb, la), F.lit(False))


# Round-name keywords.
ROUND_KEYWORDS = (
    "seed", "series a", "series b", "series c", "series d",
    "series e", "series f", "series g", "series h",
)


def normalized_name(name: Column) -> Column:
    """Lower-cased, stripped round name; null when the raw name is null or empty."""
    return F.when(has_text(name), strip(F.lower(name)))


def keyword_mask(normalized: Column) -> Column:
    """Bit i is set when keyword i occurs in the normalized name (0 for null)."""
    mask = F.lit(0)
    for bit, keyword in enumerate(ROUND_KEYWORDS):
        hit = F.coalesce(F.contains(normalized, F.lit(keyword)), F.lit(False))
        mask = mask.bitwiseOR(F.when(hit, F.lit(1 << bit)).otherwise(F.lit(0)))
    return mask


def round_names_match(a: Column, b: Column, fuzzy: bool = True) -> Column:
    """Equal after normalizing, or both holding one and the same keyword."""
    def match(pair: Column) -> Column:
        same = F.coalesce(pair["a"] == pair["b"], F.lit(False))
        if not fuzzy:
            return same
        shared = same
        for keyword in ROUND_KEYWORDS:
            both = F.contains(pair["a"], F.lit(keyword)) & F.contains(pair["b"], F.lit(keyword))
            shared = shared | F.coalesce(both, F.lit(False))
        return shared

    # A one-element transform binds the normalized names, so each is computed once.
    pair = F.struct(normalized_name(a).alias("a"), normalized_name(b).alias("b"))
    return F.get(F.transform(F.array(pair), match), F.lit(0))


def truncated_title(c: Column) -> Column:
    """Titles over 490 characters keep 490 and get an ellipsis, to fit 500."""
    return F.when(F.length(c) > 490, F.concat(F.substring(c, 1, 490), F.lit("..."))).otherwise(c)


def masked_account(account: Column) -> Column:
    """``name mail`` with the mail reduced to three characters and its domain.

    Only the second white-space token is looked at, and only when it holds exactly one
    ``@``; tokens after it are dropped. Everything else is unchanged.
    """
    tokens = F.filter(F.split(account, f"[{WHITE_SPACE}]+"), lambda t: t != "")
    mail = F.get(tokens, F.lit(1))
    local, domain = F.get(F.split(mail, "@"), F.lit(0)), F.get(F.split(mail, "@"), F.lit(1))
    single_at = (F.size(tokens) >= 2) & (F.size(F.split(mail, "@")) == 2)
    masked = F.concat(F.get(tokens, F.lit(0)), F.lit(" "), F.substring(local, 1, 3), F.lit("***@"), domain)
    return F.when(F.coalesce(single_at, F.lit(False)), masked).otherwise(account)


def masked_emails(text: Column) -> Column:
    """Every mail address in a text keeps at most three characters of its local part.

    Texts without an ``@`` are passed on unread, and a match is only tried where a word starts.
    """
    address = r"(?<![A-Za-z0-9_])([A-Za-z0-9_]{1,3}+)[A-Za-z0-9_.+-]*+@"
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, address, "$1***@")).otherwise(text)


def masked_url_password(url: Column) -> Column:
    """``scheme://user:secret@host`` with ``***`` for the secret, whether or not there is one."""
    return F.regexp_replace(url, r"://([^:/@]+)(?::[^@]*)?@", "://$1:***@")


def url_host(url: Column) -> Column:
    """Host and port: what follows the first ``@``, up to the next slash."""
    return F.split_part(F.split_part(url, F.lit("@"), F.lit(2)), F.lit("/"), F.lit(1))


def url_database(url: Column) -> Column:
    """The last path part, without the query string."""
    return F.split_part(F.split_part(url, F.lit("/"), F.lit(-1)), F.lit("?"), F.lit(1))


def joined(items: Column) -> Column:
    """A list as text, separated by comma and space; empty text for null."""
    return F.coalesce(F.array_join(items, ", "), F.lit(""))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))
