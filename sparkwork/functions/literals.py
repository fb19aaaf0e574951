"""Python literals in text, read by built-in expressions (never evaluated as code).

A line is cut into tokens by one pattern: strings (with prefixes, escapes and either quote), numbers, and the
punctuation of tuples and dicts.  A line is well-formed if nothing but white space is left between tokens and each token
is of the kind that its place in the structure asks for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: tokens of Python literals.
PREFIX = r"(?:[uU]|[bB]|[rR]|[bB][rR]|[rR][bB]|[uU][rR])?"
SINGLE = r"'(?:[^'\\]|\\.)*+'"
DOUBLE = r'"(?:[^"\\]|\\.)*+"'
STRING = f"{PREFIX}(?:{SINGLE}|{DOUBLE})"
NUMBER = r"[+-]?\s*(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?[lL]?"
PUNCTUATION = r"[(){}:,]"
TOKEN = f"(?s){STRING}|{NUMBER}|{PUNCTUATION}"
ESCAPE = r"(?s)(?:\\u[0-9a-fA-F]{4})+|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}|\\[0-7]{1,3}|\\.|[^\\]+"
#: fixed values: one-letter escapes that stand for a control character
CONTROLS = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\n": ""}


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often a lambda refers to it."""
    return F.transform(F.array(value), use)[0]


def tokens(text: Column) -> Column:
    """The tokens of a text in order; white space between them is dropped."""
    return F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1))


def only_tokens(text: Column) -> Column:
    """Whether nothing but tokens and white space stands in the text."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, TOKEN, " "), r"\s+", " ")) == ""


def is_string(token: Column) -> Column:
    return token.rlike(f"(?s)^{STRING}$")


def is_number(token: Column) -> Column:
    return token.rlike(f"^{NUMBER}$")


def number(token: Column) -> Column:
    """The value of a number token as a double."""
    return F.regexp_replace(token, r"\s+|[lL]$", "").try_cast("double")


def _unescaped_piece(piece: Column) -> Column:
    code = F.substr(piece, F.lit(2), F.lit(1))
    one = F.substr(piece, F.lit(2))
    for letter, char in CONTROLS.items():
        one = F.when(code == letter, F.lit(char)).otherwise(one)
    keeps = code.rlike(r"(?s)^['\"\\ntrabfv\n]$")  # any other backslash stands for itself
    octal = F.lpad(F.hex(F.conv(F.substr(piece, F.lit(2)), 8, 10).cast("long")), 4, "0")
    hexed = F.concat(F.lit("00"), F.substr(piece, F.lit(3)))
    return (
        F.when(~piece.startswith("\\"), piece)
        .when(code == "u", F.decode(F.unhex(F.replace(piece, F.lit("\\u"), F.lit(""))), "UTF-16BE"))
        .when(code == "U", F.decode(F.unhex(F.substr(piece, F.lit(3))), "UTF-32"))
        .when(code == "x", F.decode(F.unhex(hexed), "UTF-16BE"))
        .when(code.rlike("^[0-7]$"), F.decode(F.unhex(octal), "UTF-16BE"))
        .when(keeps, one)
        .otherwise(piece)
    )


def string(token: Column) -> Column:
    """The value of a string token: prefix and quotes taken off, escapes resolved unless the prefix has an r."""
    prefix = F.lower(F.regexp_extract(token, r"^([a-zA-Z]*)", 1))
    inner = F.substr(token, F.length(prefix) + 2, F.length(token) - F.length(prefix) - 2)
    pieces = F.transform(F.regexp_extract_all(inner, F.lit(f"({ESCAPE})"), F.lit(1)), _unescaped_piece)
    plain = prefix.contains("r") | ~inner.contains("\\")
    return F.when(plain, inner).otherwise(F.array_join(pieces, ""))


def quoted(value: Column) -> Column:
    """A string value as a literal in single quotes, on one line, that ``string`` reads back."""
    out = value
    for char, mark in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(char), F.lit(mark))
    return F.concat(F.lit("'"), out, F.lit("'"))


def labelled(text: Column) -> Column:
    """The struct (x: map<string,double>, y: double) of a literal ``({key: number, ...}, number)``; null if it is none.

    Keys are strings or numbers (as they are written); a trailing comma is allowed in the dict and in the
    tuple; of several equal keys the last counts.
    """

    def read(t: Column) -> Column:
        n = F.size(t)
        extra = (F.get(t, n - 2) == ",").cast("int")  # before the closing parenthesis
        label = F.get(t, n - 2 - extra)
        close = n - 4 - extra  # the closing brace
        body = F.slice(t, F.lit(3), F.greatest(close - 2, F.lit(0)))
        frame = (
            (n >= 6) & (F.get(t, F.lit(0)) == "(") & (F.get(t, F.lit(1)) == "{") & (F.get(t, close) == "}")
            & (F.get(t, close + 1) == ",") & is_number(label) & (F.get(t, n - 1) == ")")
        )

        def of_kind(token: Column, i: Column) -> Column:
            at = i % 4
            return (
                F.when(at == 0, is_string(token) | is_number(token))
                .when(at == 1, token == ":")
                .when(at == 2, is_number(token))
                .otherwise(token == ",")
            )

        def entries(b: Column) -> Column:
            whole = (F.size(b) % 4 == 0) | (F.size(b) % 4 == 3)
            kinds = F.forall(F.transform(b, of_kind), lambda k: k)

            def entry(i: Column) -> Column:
                key = F.get(b, i * 4)
                name = F.when(is_string(key), string(key)).otherwise(F.regexp_replace(key, r"\s+|^\s*\+|[lL]$", ""))
                return F.struct(name.alias("k"), (-i).alias("i"), number(F.get(b, i * 4 + 2)).alias("v"))

            count = F.floor((F.size(b) + 1) / 4).cast("int")
            made = F.when(count > 0, F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), entry))).otherwise(
                F.array().cast("array<struct<k:string,i:int,v:double>>")
            )
            last = let(made, lambda s: F.filter(s, lambda e, j: (j == 0) | (F.get(s, j - 1)["k"] != e["k"])))
            x = F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))
            return F.when(whole & kinds, x)

        return F.when(frame, F.struct(let(body, entries).alias("x"), number(label).alias("y")))

    return F.when(only_tokens(text), let(tokens(text), read))


# Fixed patterns: the plain form that most lines have, read without cutting them into tokens.
_PLAIN_NUMBER = r"[+-]?\d+(?:\.\d*)?(?:[eE][+-]?\d+)?"
_FRAME = rf"(?s)^\s*\(\s*\{{(.*)\}}\s*,\s*({_PLAIN_NUMBER})\s*,?\s*\)\s*$"
_PAIR = rf'"([^"\\]*+)"\s*:\s*({_PLAIN_NUMBER})'


def plain_parts(text: Column) -> Column:
    """The struct (_body, _label) of ``({...}, number)``: what stands between the braces, and the number; else empty strings.

    Single quotes are made double ones where there are no others.
    """
    body = F.regexp_extract(text, _FRAME, 1)
    body = F.when(body.contains('"'), body).otherwise(F.replace(body, F.lit("'"), F.lit('"')))
    return F.struct(body.alias("_body"), F.regexp_extract(text, _FRAME, 2).alias("_label"))


def plain_pairs(body: Column) -> Column:
    """The struct (_names, _values, _rest) of a body's pairs ``"name": number``; in the rest, each is a #, without white space."""
    rest = F.regexp_replace(F.regexp_replace(body, _PAIR, "#"), r"\s+", "")
    names, values = (F.regexp_extract_all(body, F.lit(_PAIR), F.lit(k)) for k in (1, 2))
    return F.struct(names.alias("_names"), values.alias("_values"), rest.alias("_rest"))


def labelled_of_parts(text: Column) -> Column:
    """``labelled`` for rows that have the columns of ``plain_parts`` and ``plain_pairs``: those not of the plain form are cut into tokens."""
    frame = F.repeat(F.lit("#,"), F.size("_names"))
    plain = (
        (F.col("_label") != "") & ((F.col("_rest") == frame) | (F.concat("_rest", F.lit(",")) == frame))
        & (F.size(F.array_distinct("_names")) == F.size("_names"))
    )
    x = F.map_from_arrays("_names", F.col("_values").try_cast("array<double>"))
    return F.when(plain, F.struct(x.alias("x"), F.col("_label").try_cast("double").alias("y"))).otherwise(labelled(text))
