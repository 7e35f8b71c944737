"""Predicate trees over documents.

A tree is built in Python and compiled, against the schema of one DataFrame, into a single Column.
Conditions on plain columns stay simple comparisons, so Catalyst can push them to the scan; conditions
on dynamic properties become `exists(...)` over the pairs of the same row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions import keys, text
from docsift.functions.dates import parse_date
from docsift.schema import DEFAULT_MAPPING, NSTD, PROPS, FieldMapping


Test = Callable[[Column], Column]


def all_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def any_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


class Fields:
    """The columns of one DataFrame (or of one nested object) as searchable fields."""

    def __init__(self, schema: T.StructType, mapping: FieldMapping = DEFAULT_MAPPING,
                 root: Column | None = None):
        self.schema, self.mapping, self.root = schema, mapping, root

    def has_pairs(self) -> bool:
        if PROPS not in self.schema.fieldNames():
            return False
        kind = self.schema[PROPS].dataType
        return (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)
                and "k" in kind.elementType.fieldNames())

    def is_pair(self, name: str) -> bool:
        return keys.is_nested(name) and self.has_pairs()

    def pairs(self) -> Column:
        return self.column(PROPS)

    def is_variant(self, name: str) -> bool:
        """A path into a variant column, such as `properties.owner.age` on properties left as they are."""
        first, _, rest = name.partition(".")
        return (bool(rest) and first in self.schema.fieldNames()
                and isinstance(self.schema[first].dataType, T.VariantType))

    def variant(self, name: str, kind: str) -> Column:
        first, _, rest = name.partition(".")
        return F.try_variant_get(self.column(first), f"$.{rest}", kind)

    def column(self, name: str) -> Column:
        if self.is_variant(name):
            return self.variant(name, "string")
        first, *rest = name.split(".")
        col = F.col(f"`{first}`") if self.root is None else self.root[first]
        return reduce(lambda c, part: c[part], rest, col)

    def type_of(self, name: str) -> T.DataType:
        if self.is_variant(name):
            return T.StringType()
        kind: T.DataType = self.schema
        for part in name.split("."):
            if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
                raise ValueError(f"unknown field {name!r}")
            kind = kind[part].dataType
        return kind

    def is_text(self, name: str) -> bool:
        kind = self.type_of(name)
        if isinstance(kind, T.ArrayType):
            kind = kind.elementType
        return isinstance(kind, T.StringType) and not self.mapping.is_keyword(name)

    def each(self, name: str, test: Test) -> Column:
        """Apply `test` to the indexed unit: the value, each array item, or each word of a text."""
        kind, col = self.type_of(name), self.column(name)
        if isinstance(kind, T.ArrayType):
            if self.is_text(name):
                return F.exists(col, lambda x: F.exists(text.tokens(x), test))
            return F.exists(col, test)
        if self.is_text(name):
            return F.exists(text.tokens(col), test)
        return test(col)

    def literal(self, name: str, value: Any) -> Column:
        """The search value as a constant of the column's own type."""
        kind = self.type_of(name)
        if isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if not isinstance(value, str):
            if isinstance(kind, T.StringType):
                value = "true" if value is True else "false" if value is False else str(value)
            else:
                value = value if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) \
                    or not isinstance(value, (int, float)) else str(int(value))
        if isinstance(value, str) and not isinstance(kind, T.StringType):
            value = value.strip()
            if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
                return parse_date(F.lit(value)).cast(kind)
            if isinstance(kind, T.BooleanType):
                return F.lit(value == "true")
            if isinstance(kind, T.NumericType):
                try:
                    return F.lit(int(value) if keys.is_digits(value.lstrip("-")) else float(value))
                except ValueError:
                    raise ValueError(f"{value!r} is not a number, but {name!r} is") from None
        return F.lit(value)


# ---------------------------------------------------------------- pairs of dynamic properties

def _key_words(pair: Column, typed: bool) -> Column:
    return pair["kt"] if typed else text.tokens(pair["k"])


def _value_words(pair: Column, typed: bool) -> Column:
    return pair["vt"] if typed else text.tokens(pair["v"])


def pair_key(pair: Column, name: str, typed: bool) -> Column:
    """All words of the translated name occur in the stored key. Keys that are not analysed yet are taken apart only if
    they hold the first and the last of these words as they stand."""
    words = text.tokens(F.lit(keys.nested_key(name)))
    found = text.contains_all(_key_words(pair, typed), words)
    if typed:
        return found
    key = F.lower(pair["k"])
    return key.contains(F.get(words, F.lit(0))) & key.contains(F.get(words, F.size(words) - 1)) & found


def any_pair(fields: Fields, name: str, test: Callable[[Column, bool], Column] | None) -> Column:
    """Some pair has the key, and the same pair passes the test."""
    kind = fields.schema[PROPS].dataType.elementType
    typed = "kt" in kind.fieldNames()

    def one(pair: Column) -> Column:
        key = pair_key(pair, name, typed)
        return key if test is None else key & test(pair, typed)

    return F.exists(fields.pairs(), one)


def pair_equals(value: str) -> Callable[[Column, bool], Column]:
    """Digits look at the number slot, anything else at the words of the text slot."""
    if keys.is_digits(value):
        return lambda p, typed: pair_number(p, typed, value)
    return lambda p, typed: text.contains_all(_value_words(p, typed), text.tokens(F.lit(value)))


def pair_number(pair: Column, typed: bool, digits: str) -> Column:
    """The number slot equals an integer; exactly so where the pair was an integer itself."""
    near = pair["vn"] == F.lit(float(digits))
    if not typed or int(digits) >= 1 << 63:
        return near
    return F.when(pair["vl"].isNotNull(), pair["vl"] == F.lit(int(digits))).otherwise(near)


def pair_word(value: str, test: Test) -> Callable[[Column, bool], Column]:
    """A test on single words of the text slot; digits would look at numbers, which have no words."""
    if keys.is_digits(value):
        return lambda p, typed: F.lit(False)
    return lambda p, typed: F.exists(_value_words(p, typed), test)


# ---------------------------------------------------------------- the tree

@dataclass(frozen=True)
class Query:
    """Base of all predicates; `&`, `|` and `~` build boolean combinations."""

    def compile(self, fields: Fields) -> Column:
        raise NotImplementedError

    def __and__(self, other: "Query") -> "Query":
        return Bool(must=(self, other))

    def __or__(self, other: "Query") -> "Query":
        return Bool(should=(self, other))

    def __invert__(self) -> "Query":
        return Bool(must_not=(self,))


@dataclass(frozen=True)
class MatchAll(Query):
    def compile(self, fields: Fields) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class Where(Query):
    """Any Column-valued function as a leaf."""

    fn: Callable[[], Column]

    def compile(self, fields: Fields) -> Column:
        return self.fn()


@dataclass(frozen=True)
class Bool(Query):
    """`should` is optional as soon as there is a `must` or a `filter`."""

    must: Sequence[Query] = ()
    should: Sequence[Query] = ()
    must_not: Sequence[Query] = ()
    filter: Sequence[Query] = ()

    def compile(self, fields: Fields) -> Column:
        needed = [q.compile(fields) for q in (*self.must, *self.filter)]
        parts = list(needed)
        if self.should and not needed:
            parts.append(any_of([q.compile(fields) for q in self.should]))
        parts += [~F.coalesce(q.compile(fields), F.lit(False)) for q in self.must_not]
        return all_of(parts)


@dataclass(frozen=True)
class Term(Query):
    """Exact value of a known field, or words of a dynamic property (`*` asks for its existence)."""

    field: str
    value: Any

    def compile(self, fields: Fields) -> Column:
        if fields.is_pair(self.field):
            value = str(self.value)
            return any_pair(fields, self.field, None if value == "*" else pair_equals(value))
        if fields.is_variant(self.field) and keys.is_digits(str(self.value)):
            return fields.variant(self.field, "double") == F.lit(float(self.value))
        literal = fields.literal(self.field, self.value)
        if isinstance(fields.type_of(self.field), T.ArrayType) and not fields.is_text(self.field):
            return F.array_contains(fields.column(self.field), literal)
        return fields.each(self.field, lambda u: u == literal)


@dataclass(frozen=True)
class Match(Query):
    """Analysed search in one field: any word of a text field; other fields as in `Term`."""

    field: str
    value: str

    def compile(self, fields: Fields) -> Column:
        if fields.is_pair(self.field) or not fields.is_text(self.field):
            return Term(self.field, self.value).compile(fields)
        words = text.tokens(F.lit(self.value))
        return fields.each(self.field, lambda u: F.array_contains(words, u))


@dataclass(frozen=True)
class Exists(Query):
    field: str

    def compile(self, fields: Fields) -> Column:
        if fields.is_pair(self.field):
            return any_pair(fields, self.field, None)
        return fields.column(self.field).isNotNull()


@dataclass(frozen=True)
class Range(Query):
    """`*` leaves a bound open. Both bounds open: existence of a property, or everything."""

    field: str
    low: Any = "*"
    high: Any = "*"
    include_low: bool = True
    include_high: bool = True

    def _test(self, low: Column | None, high: Column | None) -> Test:
        def test(u: Column) -> Column:
            parts = []
            if low is not None:
                parts.append(u >= low if self.include_low else u > low)
            if high is not None:
                parts.append(u <= high if self.include_high else u < high)
            return all_of(parts)
        return test

    def compile(self, fields: Fields) -> Column:
        low = None if self.low in ("*", None) else self.low
        high = None if self.high in ("*", None) else self.high
        nested = fields.is_pair(self.field)
        if low is None and high is None:
            return Exists(self.field).compile(fields) if nested else F.lit(True)
        if nested:
            bounds = [b if b is None else str(b) for b in (low, high)]
            if any(b is not None and keys.is_digits(b) for b in bounds):
                ends = [None if b is None else F.lit(float(b)) for b in bounds]
                if all(b is None or keys.is_digits(b) and int(b) < 1 << 63 for b in bounds):
                    exact = [None if b is None else F.lit(int(b)) for b in bounds]
                    return any_pair(fields, self.field, lambda p, typed: F.when(
                        p["vl"].isNotNull(), self._test(*exact)(p["vl"])).otherwise(self._test(*ends)(p["vn"]))
                        if typed else self._test(*ends)(p["vn"]))
                return any_pair(fields, self.field, lambda p, typed: self._test(*ends)(p["vn"]))
            ends = [None if b is None else F.lit(b) for b in bounds]
            return any_pair(fields, self.field,
                            lambda p, typed: F.exists(_value_words(p, typed), self._test(*ends)))
        if fields.is_variant(self.field) and any(
                b is not None and keys.is_digits(str(b)) for b in (low, high)):
            ends = [None if b is None else F.lit(float(b)) for b in (low, high)]
            return self._test(*ends)(fields.variant(self.field, "double"))
        ends = [None if b is None else fields.literal(self.field, b) for b in (low, high)]
        return fields.each(self.field, self._test(*ends))


@dataclass(frozen=True)
class _Pattern(Query):
    """A test on whole keyword values or single words; the pattern itself is never lower-cased."""

    field: str | None
    value: str

    def test(self, unit: Column) -> Column:
        raise NotImplementedError

    def compile(self, fields: Fields) -> Column:
        if not self.field:
            # without a field the pattern reaches the words of properties only; the other
            # fields are compared with the pattern's text as it stands
            parts = [Text(self.value, in_pairs=False).compile(fields)]
            if fields.has_pairs() and not keys.is_digits(self.value):
                typed = "kt" in fields.schema[PROPS].dataType.elementType.fieldNames()
                parts.append(F.exists(fields.pairs(), lambda p: F.exists(
                    _value_words(p, typed), self.test)))
            return any_of([F.coalesce(p, F.lit(False)) for p in parts])
        if fields.is_pair(self.field):
            return any_pair(fields, self.field, pair_word(self.value, self.test))
        return fields.each(self.field, self.test)


@dataclass(frozen=True)
class Prefix(_Pattern):
    def test(self, unit: Column) -> Column:
        return unit.startswith(self.value)


@dataclass(frozen=True)
class Wildcard(_Pattern):
    def test(self, unit: Column) -> Column:
        # the literal head and plain patterns can be told to the scan; a regular expression can't
        head = re.match(r"[^*?\\]*", self.value)[0]
        whole = unit.rlike(text.wildcard_regex(self.value))
        if not re.search(r"[\\%_]", self.value):
            whole = unit.like(self.value.replace("*", "%").replace("?", "_"))
        return unit.startswith(head) & whole if head else whole


@dataclass(frozen=True)
class Fuzzy(_Pattern):
    """Within the number of edits that the length of the term allows."""

    def test(self, unit: Column) -> Column:
        return text.within_edits(unit, self.value)


@dataclass(frozen=True)
class Text(Query):
    """A word or phrase with no field: any field of the document, or any pair, key included."""

    value: str
    in_pairs: bool = True

    def compile(self, fields: Fields) -> Column:
        words = text.tokens(F.lit(self.value))
        number = float(self.value) if keys.is_digits(self.value) else None
        parts = []
        for f in fields.schema.fields:
            name, kind = f.name, f.dataType
            item = kind.elementType if isinstance(kind, T.ArrayType) else kind
            if name.startswith("_"):
                continue
            col = fields.column(name)
            if isinstance(item, T.StringType):
                if fields.is_text(name):
                    parts.append(fields.each(name, lambda u: F.array_contains(words, u)))
                elif item is kind:
                    parts.append(col == F.lit(self.value))
                else:
                    parts.append(F.array_contains(col, F.lit(self.value)))
            elif isinstance(item, T.NumericType) and item is kind and number is not None:
                exact = isinstance(item, T.IntegralType) and int(self.value) < 1 << 63
                parts.append(col == F.lit(int(self.value) if exact else number))
        if self.in_pairs and fields.has_pairs():
            typed = "kt" in fields.schema[PROPS].dataType.elementType.fieldNames()

            def pair(p: Column) -> Column:
                hit = (F.arrays_overlap(_key_words(p, typed), words)
                       | F.coalesce(F.arrays_overlap(_value_words(p, typed), words), F.lit(False)))
                return hit if number is None else hit | F.coalesce(pair_number(p, typed, self.value), F.lit(False))

            parts.append(F.exists(fields.pairs(), pair))
        return any_of([F.coalesce(p, F.lit(False)) for p in parts])


@dataclass(frozen=True)
class Nested(Query):
    """A predicate that one object of an array must satisfy on its own."""

    query: Query
    path: str = NSTD

    def compile(self, fields: Fields) -> Column:
        inner = fields.type_of(self.path)
        if not (isinstance(inner, T.ArrayType) and isinstance(inner.elementType, T.StructType)):
            raise ValueError(f"{self.path!r} is not an array of objects")
        return F.exists(fields.column(self.path), lambda o: F.coalesce(
            self.query.compile(Fields(inner.elementType, fields.mapping, o)), F.lit(False)))


@dataclass(frozen=True)
class Boost(Query):
    """Weighs a clause in scored search; as a predicate it is its inner query."""

    query: Query
    factor: float = 1.0

    def compile(self, fields: Fields) -> Column:
        return self.query.compile(fields)


class Q:
    """Short names for building trees: `Q.term("type", "cat") & ~Q.range("year", 2018, "*")`."""

    match_all = MatchAll
    where = Where
    term = Term
    text = Text
    match = Match
    exists = Exists
    range = Range
    prefix = Prefix
    wildcard = Wildcard
    fuzzy = Fuzzy
    nested = Nested
    boost = Boost

    @staticmethod
    def bool(must: Sequence[Query] = (), should: Sequence[Query] = (),
             must_not: Sequence[Query] = (), filter: Sequence[Query] = ()) -> Bool:
        return Bool(tuple(must), tuple(should), tuple(must_not), tuple(filter))


def condition(df: DataFrame, query: Query, mapping: FieldMapping = DEFAULT_MAPPING) -> Column:
    """Compile a tree against the schema of `df`."""
    return query.compile(Fields(df.schema, mapping))


def terms_query(terms: Mapping[str, Any] | None, match_all: bool = True) -> Query | None:
    """A field->value map as one predicate, or None when nothing usable is in it.

    A key may end in `<`, `>`, `<=` or `>=`. Blank keys, and values that are null, blank or not
    plain scalars, are skipped.
    """
    parts: list[Query] = []
    for key, value in (terms or {}).items():
        if not key or not key.strip() or not isinstance(value, (str, int, float, bool)):
            continue
        if not str(value).strip():
            continue
        name, op = keys.split_operator(key)
        if op is None:
            parts.append(Term(name, value))
        elif op in (">", ">="):
            parts.append(Range(name, value, "*", include_low=op == ">="))
        else:
            parts.append(Range(name, "*", value, include_high=op == "<="))
    if not parts:
        return None
    if len(parts) == 1:
        return parts[0]
    return Bool(must=tuple(parts)) if match_all else Bool(should=tuple(parts))
