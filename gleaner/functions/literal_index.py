"""One index of all the plain texts that patterns need.

An automaton finds every literal in one pass over a text, in Arrow batches, whatever the number of
patterns; a pattern is then tried only in a text in which a literal that it needs was found. Texts are
in lower case, as the literals are. A null text has no literal. Parts of a text can use its index too: what the whole
doesn't have, no part has.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(16)
def automaton(literals: tuple[str, ...]):
    """The automaton of literals, whose values are their places; one for each worker."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, literal in enumerate(literals):
        found.add_word(literal, i)
    found.make_automaton()
    return found


class LiteralIndex:
    """The literals of patterns, each with a place."""

    def __init__(self, literals: list[str]):
        self.literals = tuple(dict.fromkeys(x for x in literals if x))
        self.places = {x: i for i, x in enumerate(self.literals)}

    def found(self, text: Column) -> Column:
        """An array that says of each literal whether the text has it."""
        literals = self.literals

        @F.arrow_udf("array<boolean>")
        def look(texts: pa.Array) -> pa.Array:
            search, n = automaton(literals), len(literals)
            out = np.zeros((len(texts), n), bool)
            for row, text in zip(out, texts.to_pylist(), strict=True):
                for _, i in search.iter(text or ""):
                    row[i] = True
            return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * n), pa.array(out.ravel()))

        return look(text)


@dataclass
class Indexed:
    """A column of texts in lower case, by name, with that of what the index has found in it (`whole`), or in a text that it is part of.

    Conditions are SQL, so that a rule of many patterns is one expression that Spark parses, not hundreds of calls.
    """

    text: str
    index: LiteralIndex
    seen: str
    whole: bool

    def has(self, literal: str) -> str:
        """Whether the whole text has a literal of the index."""
        return f"get({self.seen}, {self.index.places[literal]})"

    def contains(self, literal: str) -> str:
        return self.has(literal) if self.whole else f"({self.has(literal)} AND contains({self.text}, {quoted(literal)}))"

    def rlike(self, pattern: str) -> str:
        return f"{self.text} RLIKE {quoted(pattern)}"

    def count(self, pattern: str) -> str:
        return f"regexp_count({self.text}, {quoted(pattern)})"


def quoted(text: str) -> str:
    """A text as a literal of Spark's SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
