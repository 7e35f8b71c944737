"""Text analysis as Column expressions: tokens, term counts, patterns, edit distance."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word keeps inner dots and apostrophes ("john.doe", "don't").
TOKEN_RE = r"[\p{L}\p{N}_]+(?:[.'’][\p{L}\p{N}_]+)*"


def tokens(text: Column) -> Column:
    """Lower-cased words in order of appearance; null text gives null."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RE), 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), 0)


def term_counts(toks: Column) -> Column:
    """Distinct words of one row with their counts: array<struct<term, tf>>.

    The sorted token array is cut at its value changes, so counting needs no shuffle.
    """

    def cut(s: Column) -> Column:
        starts = F.filter(
            F.transform(s, lambda x, i: F.struct(x.alias("term"), i.alias("at"))),
            lambda e: (e["at"] == 0) | (F.get(s, e["at"] - 1) != e["term"]),
        )
        return let(starts, lambda st: F.transform(st, lambda e, j: F.struct(
            e["term"].alias("term"),
            (F.coalesce(F.get(st, j + 1)["at"], F.size(s)) - e["at"]).cast("int").alias("tf"),
        )))

    return let(F.sort_array(toks), cut)


def count_of(toks: Column, term: Column) -> Column:
    """How often `term` occurs in the token array."""
    return F.size(F.filter(toks, lambda t: t == term))


def contains_all(toks: Column, wanted: Column) -> Column:
    """Every wanted token occurs; nothing matches an empty wanted list."""
    return (F.size(wanted) > 0) & F.forall(wanted, lambda w: F.array_contains(toks, w))


def wildcard_regex(pattern: str) -> str:
    """Anchored regular expression for `*`, `?` and the backslash escape."""
    out, chars = [], iter(pattern)
    for ch in chars:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "\\":
            out.append(re.escape(next(chars, "\\")))
        else:
            out.append(re.escape(ch))
    return "^(?s:" + "".join(out) + ")$"


def auto_edits(term: str) -> int:
    """Edits allowed by term length: 0 up to two letters, 1 up to five, 2 above."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def _swaps(word: str) -> list[tuple[int, str]]:
    return [(i, word[:i] + word[i + 1] + word[i] + word[i + 2:])
            for i in range(len(word) - 1) if word[i] != word[i + 1]]


def within_edits(token: Column, term: str, edits: int | None = None) -> Column:
    """True when `token` is at most `edits` edits from `term`; a swap of neighbours is one edit.

    This is the optimal-string-alignment distance: no letter is edited twice. The term is a
    literal, so its swaps are spelled out here. One swap at i leaves a budget of one plain edit, which
    must lie wholly before or wholly behind the swapped pair; two swaps must not overlap.
    """
    k = auto_edits(term) if edits is None else edits
    if k == 0:
        return token == term
    if k > 2:
        raise ValueError("at most two edits are supported")
    close = F.levenshtein(token, F.lit(term), k) >= 0
    swapped = [w for _, w in _swaps(term)]
    if k == 2:
        swapped += [w2 for i, w in _swaps(term) for j, w2 in _swaps(w) if j >= i + 2]
        for i, w in _swaps(term):
            head, pair, tail = term[:i], w[i:i + 2], term[i + 2:]
            rest = F.substring(token, F.lit(i + 3), F.length(token))
            front = F.substring(token, F.lit(1), F.length(token) - 2 - len(tail))
            close = close | (token.startswith(head + pair)
                             & (F.levenshtein(rest, F.lit(tail), 1) >= 0))
            close = close | (token.endswith(pair + tail)
                             & (F.levenshtein(front, F.lit(head), 1) >= 0))
    if swapped:
        close = close | token.isin(sorted(set(swapped)))
    return F.length(token).between(len(term) - k, len(term) + k) & close
