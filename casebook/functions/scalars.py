"""Cleaning functions: Column in, Column out. Missing values are null throughout."""

from __future__ import annotations

from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from casebook.functions import fixed

SEP = "; "


def strip(c: Column) -> Column:
    """White space of any script off both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


@pandas_udf(StringType())
def _xml_text(s: pd.Series) -> pd.Series:
    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            return " ".join(ElementTree.fromstring(f"<items> {text} </items>").itertext())
        except ElementTree.ParseError:
            return None

    return s.map(one, na_action="ignore").astype(object)


def xml_text(c: Column) -> Column:
    """Text of an XML fragment, its pieces one space apart; null if malformed, empty or a dash.

    Only fragments with markup go to the parser; others are their own text.
    """
    markup = c.rlike(r"[<&\x00-\x08\x0b\x0c\x0e-\x1f]|]]>")
    out = strip(F.when(markup, _xml_text(F.when(markup, c))).otherwise(c))
    return F.when(~out.isin("", "-"), out)


def unify_list(c: Column) -> Column:
    """``a, b, a`` to ``a; b``: distinct, in order of the alphabet."""
    return F.array_join(F.array_sort(F.array_distinct(F.split(c, ", "))), SEP)


def unify_list_text(c: Column) -> Column:
    """``['a', 'b']`` to ``a; b``."""
    for old, new in (("', '", SEP), ("['", ""), ("']", "")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def pick_celex(c: Column) -> Column:
    """Of several identifiers the first without an underscore; a lone one as it is."""
    return F.when(F.contains(c, F.lit(";")), F.get(F.filter(F.split(c, ";"), lambda x: ~F.contains(x, F.lit("_"))), 0)).otherwise(c)


def iso_date(c: Column) -> Column:
    return F.try_to_date(c, "yyyy-MM-dd")


#: Tried in turn: month first where the parts don't tell.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy h:mm:ss a", "M/d/yyyy HH:mm:ss", "M/d/yyyy", "M-d-yyyy", "d/M/yyyy HH:mm:ss", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyyMMdd")


def any_date(c: Column) -> Column:
    """A date in one of the formats of ``DATE_FORMATS``, or null."""
    return F.coalesce(*[F.try_to_date(c, f) for f in DATE_FORMATS])


def numeric_date(c: Column) -> Column:
    """``20200131`` or ``20200131.0``."""
    return F.try_to_date(c.try_cast("double").try_cast("bigint").cast("string"), "yyyyMMdd")


def label_domains(c: Column) -> Column:
    """A single domain also gets its unlabelled subdomain."""
    return F.when(F.size(F.split(c, SEP)) == 1, F.concat(c, F.lit(SEP), c, F.lit("-" + fixed.UNLABELLED))).otherwise(c)


def expand_domains(c: Column, table: dict[str, list[str]]) -> Column:
    """Every element of a list text replaced by all that ``table`` has for it (unknown ones go; null if none is left), then :func:`label_domains`."""
    entries = [x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    found = F.transform(F.array_distinct(F.split(unify_list_text(c), SEP)), lambda d: F.try_element_at(F.create_map(*entries), d))
    return label_domains(none_if_empty(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.filter(found, lambda x: x.isNotNull())))), SEP)))


def first_year(c: Column) -> Column:
    """What stands before the first dash."""
    return F.split_part(c, F.lit("-"), F.lit(1))


def cascade(c: Column, pairs=fixed.INSTANCES, longest_first: bool = False) -> Column:
    """Ordered literal replacements, each on the result of those before; ``longest_first`` keeps long names from being cut up."""
    for old, new in sorted(pairs, key=lambda p: -len(p[0])) if longest_first else pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def alternative_sources(c: Column) -> Column:
    """Lines of an XML fragment as a list text."""
    return F.regexp_replace(xml_text(c), " *\n *", SEP)


def jurisdiction(c: Column) -> Column:
    """Null for unknown values; see :func:`casebook.operators.tables.rejects`."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in fixed.JURISDICTIONS.items() for x in kv]), c)


def ecli_year(c: Column) -> Column:
    """The fourth field of an ECLI, or null."""
    return F.get(F.split(c, ":"), 3)


def is_ecli(c: Column) -> Column:
    return c.rlike(r"^ECLI:[A-Z]{2}:[A-Z0-9]+:\d{4}:[A-Z0-9.]+$")


def law_path(c: Column) -> Column:
    """A law element's id without its prefix; null for other subjects."""
    n = len(fixed.LAW_PREFIX)
    return F.when(F.startswith(c, F.lit(fixed.LAW_PREFIX)) & (F.length(c) > n), F.substring(c, F.lit(n + 1), F.length(c)))


def segment(c: Column, i: int) -> Column:
    """The i-th part of a path (negative: from the end); null if empty or missing."""
    return none_if_empty(F.try_element_at(F.split(c, "/"), F.lit(i + 1 if i >= 0 else i)))


def reference_fields(c: Column) -> Column:
    """``k=v|k=v`` as a map: the first equals sign splits, a key without value is null, the last of equal keys wins."""
    keys = F.transform(F.split(c, r"\|"), lambda x: F.split_part(x, F.lit("="), F.lit(1)))

    def last(ks: Column) -> Column:
        # of equal keys the last: a field stays if its key's first place from the end is its own
        back = F.reverse(ks)
        own = F.filter(F.transform(F.split(c, r"\|"), lambda x, i: F.struct(x.alias("x"), F.get(ks, i).alias("key"), i.alias("i"))), lambda e: F.array_position(back, e["key"]) == F.size(ks) - e["i"])
        return F.map_from_entries(F.transform(own, lambda e: F.struct(e["key"].alias("key"), F.when(F.contains(e["x"], F.lit("=")), F.substring(e["x"], F.instr(e["x"], "=") + 1, F.length(e["x"]))).alias("value"))))

    return F.get(F.transform(F.array(keys), last), 0)


def clean_title(c: Column) -> Column:
    """Leading punctuation off, white space single."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^[\s.,;:]+", ""), r"(?U)\s+", " ")


def escape_iri(line: Column) -> Column:
    """Spaces within ``<...>`` as %20."""
    parts = F.split(line, "(?=<)|(?<=>)")
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^<[^>]*>$"), F.replace(p, F.lit(" "), F.lit("%20"))).otherwise(p)), "")


@pandas_udf(StringType())
def _literal_json(s: pd.Series) -> pd.Series:
    import ast
    import json

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(ast.literal_eval(text), ensure_ascii=False)
        except (ValueError, SyntaxError, TypeError):
            return None

    return s.map(one, na_action="ignore").astype(object)


def citation_fields(c: Column, field: str) -> Column:
    """``field`` of every dict in a list written as a Python literal; missing ones are empty strings.

    Literals that JSON reads too stay out of Python.
    """
    schema = "array<map<string,string>>"
    options = {"allowSingleQuotes": "true"}
    simple = F.from_json(c, schema, options)
    rest = F.from_json(_literal_json(F.when(simple.isNull(), c)), schema)
    return F.transform(F.coalesce(simple, rest), lambda m: F.coalesce(F.try_element_at(m, F.lit(field)), F.lit("")))


def as_set(c: Column) -> Column:
    """A list text as a sorted array of distinct elements."""
    return F.array_sort(F.array_distinct(F.split(c, SEP)))


def month_end(c: Column) -> Column:
    return F.last_day(c)


def keyed(*parts: Column | str) -> Column:
    """A compound key."""
    return F.concat_ws("_", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def clean_name(path: str) -> str:
    """Name of a processed file."""
    return path.replace(".csv", "_clean.csv")


def unquote(c: Column) -> Column:
    """Quotation marks off the keys of a JSON text."""
    return F.regexp_replace(c, r'"(\w+)"\s*:', "$1:")
