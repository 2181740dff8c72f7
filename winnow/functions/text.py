"""Text columns: missing tokens, literal lists, atom tokens and fragments (P3-P5, P13, string helpers)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.numbers import ratio

# Words that count as a missing string.
MISSING_WORDS = ("", "nan", "none")

# One token per atom, bracketed atoms as one token.
ATOM_TOKEN = r"\[[^\]]*\]|Br|Cl|[BCNOPSFI]|[bcnops]"
BRACKET_SYMBOL = r"^\[[0-9]*([A-Za-z][a-z]?)"
BRACKET_HYDROGEN = r"^\[[0-9]*H[0-9+\-]*\]$"
BRACKET_CHARGE = r"^\[[^\]]*[+\-]"
BRACKET_ISOTOPE = r"^\[[0-9]+"
RING_CLOSURE = r"%[0-9][0-9]|[0-9]"
AROMATIC = ("b", "c", "n", "o", "p", "s", "se", "as")
HALOGENS = ("F", "Cl", "Br", "I")
STEREO_MARKS = r"[@/\\]"


def clean_token(col: Column) -> Column:
    """Trimmed text, or NULL for null, empty, "nan" and "none" in any case."""
    text = F.trim(col.cast("string"))
    return F.when(~F.lower(text).isin(*MISSING_WORDS), text)


def parse_list(col: Column) -> Column:
    """``"['C', 'N']"`` to an array of text; anything unreadable becomes an empty list."""
    parsed = F.from_json(F.translate(col, "'", '"'), "array<string>")
    return F.coalesce(parsed, F.array().cast("array<string>"))


def file_stem(path: Column) -> Column:
    """Last path part up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def truncate(col: Column, length: int, suffix: str = "...") -> Column:
    short = F.concat(F.substring(col, 1, length - len(suffix)), F.lit(suffix))
    return F.when(F.length(col) > length, short).otherwise(col)


def property_key(col: Column) -> Column:
    return F.translate(col, "\\", "")


def contains_ci(col: Column, needle: str) -> Column:
    return F.lower(col).contains(needle.lower())


def atom_tokens(col: Column) -> Column:
    tokens = F.regexp_extract_all(col, F.lit(ATOM_TOKEN), 0)
    return F.filter(tokens, lambda t: ~t.rlike(BRACKET_HYDROGEN))


def _symbol(token: Column) -> Column:
    """Element symbol as written (lower case when aromatic) of an atom token."""
    inner = F.regexp_extract(token, BRACKET_SYMBOL, 1)
    one = F.substring(inner, 1, 1)
    two_letter = F.lower(inner).isin(*TWO_LETTER)
    return F.when(token.startswith("["), F.when(two_letter, inner).otherwise(one)).otherwise(token)


# Two-letter elements that occur in bracketed atoms; "[nH]" is nitrogen, not "nh".
TWO_LETTER = (
    "br", "cl", "si", "se", "as", "na", "li", "mg", "al", "ca", "fe", "zn", "cu", "sn", "pt", "pd", "te", "ge",
)


def _n(arr: Column, pred) -> Column:
    return F.size(F.filter(arr, pred)).cast("long")


def _of(elements: Column, symbol: str) -> Column:
    return _n(elements, lambda s: s == symbol)


def token_profile(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """Counts that can be read off a line-notation string without interpreting it.

    Adds tokens' element symbols, atom counts (of each halogen as well), marked stereo centres (atoms
    with "@"), charge and isotope flags, fragments, ring closures and bonds (atoms - fragments +
    rings).  Bracketed hydrogens are not heavy atoms.  Centres without a mark can't be told from the
    text, so ``n_stereo_undefined`` has to come with the table.
    """
    text, p = F.coalesce(F.col(col), F.lit("")), prefix
    parts = df.withColumn("__atoms", atom_tokens(text)).withColumn(
        "__symbols", F.transform("__atoms", _symbol)
    )
    sym, atoms = F.col("__symbols"), F.col("__atoms")
    bare = F.regexp_replace(text, r"\[[^\]]*\]", "")
    closures = F.size(F.regexp_extract_all(bare, F.lit(RING_CLOSURE), 0))
    element = F.transform(sym, lambda s: F.initcap(s))
    out = parts.withColumns(
        {
            p + "symbols": F.array_sort(F.array_distinct(element)),
            p + "heavy_atoms": F.size(atoms).cast("long"),
            p + "hetero_atoms": _n(element, lambda s: s != "C"),
            p + "n_nitrogen": _n(element, lambda s: s == "N"),
            p + "n_sulfur": _n(element, lambda s: s == "S"),
            p + "n_halogen": _n(element, lambda s: s.isin(*HALOGENS)),
            **{f"{p}n_{e}": _of(element, e) for e in HALOGENS},
            p + "n_stereo": _n(atoms, lambda a: a.contains("@")),
            p + "n_aromatic": _n(sym, lambda s: s.isin(*AROMATIC)),
            p + "has_charge": F.exists(atoms, lambda a: a.rlike(BRACKET_CHARGE)),
            p + "has_isotope": F.exists(atoms, lambda a: a.rlike(BRACKET_ISOTOPE)),
            p + "n_fragments": _n(F.split(text, r"\."), lambda f: f != ""),
            p + "n_rings": F.floor(closures / 2).cast("long"),
        }
    ).drop("__atoms", "__symbols")
    bonds = F.col(p + "heavy_atoms") - F.col(p + "n_fragments") + F.col(p + "n_rings")
    return out.withColumn(p + "n_bonds", F.greatest(bonds, F.lit(0)).cast("long"))


def largest_fragment(col: Column, pattern: str = ATOM_TOKEN) -> Column:
    """The dot-separated part with the most tokens; the first of equals."""
    ranked = F.transform(
        F.split(F.trim(col), r"\."),
        lambda frag, i: F.struct(
            F.size(F.regexp_extract_all(frag, F.lit(pattern), 0)).alias("n"),
            (-i).alias("pos"),
            frag.alias("frag"),
        ),
    )
    return F.array_max(ranked)["frag"]


def prepare_text(col: Column) -> Column:
    """Clean, keep the largest fragment, drop stereo marks."""
    return F.regexp_replace(largest_fragment(clean_token(col)), STEREO_MARKS, "")


def atom_ratios(df: DataFrame, n: str = "n_nitrogen", s: str = "n_sulfur", heavy: str = "heavy_atoms") -> DataFrame:
    return df.withColumns(
        {
            "fn_atoms": ratio(F.col(n), F.col(heavy)),
            "fns_atoms": ratio(F.col(n) + F.col(s), F.col(heavy)),
        }
    )


def solubility(logp: Column, weight: Column, rotatable: Column, aromatic: Column) -> Column:
    """Linear estimate; the coefficients are fixed values."""
    return F.lit(0.16) - 0.63 * logp - 0.0062 * weight + 0.066 * rotatable - 0.74 * aromatic


def words(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit("[^ \\t\\r\\n]+"), 0)


def any_of(col: Column, needles: Sequence[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | contains_ci(col, n)
    return out
