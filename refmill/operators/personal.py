"""Personal names and postal addresses in texts, as expressions that need no join and no Python.

Names: a model learns from a table of names and from texts which first names, and which endings of family
names, are commoner in names than in texts. What it keeps is written as tries inside patterns, by
strength of evidence. A candidate is a pair of capitalised words with up to two words before it; its points
are those of its words and of its surroundings. Addresses: a grammar over classes of tokens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Detector = Callable[[Column], Column]

# --- fixed values: words around names and in addresses
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Madame", "Monsieur", "Señor", "Señora")
CUES = ("dear", "contact", "from", "by", "signed", "sincerely", "regards", "name", "called", "named", "meet", "with", "for", "to")
STREETS = (
    "Street St Road Rd Avenue Ave Lane Ln Drive Close Court Way Place Square Terrace Crescent Gardens Hill "
    "Grove Row Mews Boulevard Blvd Parade Walk"
).split()
UNITS = ("Flat", "Apartment", "Apt", "Unit", "Suite", "Room", "Floor")

PERSON_SCORE, ADDRESS_SCORE, STREET_SCORE = 0.85, 0.85, 0.5

_WORD = r"\p{Lu}\p{Ll}+(?:['’-]\p{Lu}?\p{Ll}+)*"
_TITLE = rf"(?:{'|'.join(TITLES)})\.?"
#: up to two words that are titles or begin small, then two or three capitalised words or an initial between two
_CANDIDATE = rf"(?:(?<![\p{{L}}\p{{N}}])(?:{_TITLE}|\p{{Ll}}[^\s]*)\s+){{0,2}}(?<![\p{{L}}\p{{N}}]){_WORD}(?:\s+\p{{Lu}}\.)?\s+{_WORD}(?:\s+{_WORD})?"

#: texts without such a pair have no candidate
_PAIR = rf"{_WORD}(?:\s+\p{{Lu}}\.)?\s+\p{{Lu}}\p{{Ll}}"

MAX_NODES = 5_000  # first names and endings a model keeps, most telling first
_ENDINGS = (3, 4, 5)  # letters
_LEVELS = (1.0, 2.5, 4.0)  # log-odds from which a word has one, two and three points
ENOUGH = 4  # points of a name


def trie_pattern(words: Iterable[str]) -> str:
    """A pattern for exactly these words, with common beginnings written once."""
    root: dict = {}
    for word in words:
        node = root
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def written(node: dict) -> str:
        parts = [re.escape(letter) + written(node[letter]) for letter in sorted(node) if letter]
        if not parts:
            return ""
        inner = parts[0] if len(parts) == 1 and "" not in node else f"(?:{'|'.join(parts)})"
        return inner + ("?" if "" in node else "")

    return written(root) or r"(?!)"


@dataclass(frozen=True)
class NameModel:
    """Patterns of first names and of endings of family names with one, two and three points or more."""

    first: tuple[str, ...]
    endings: tuple[str, ...]

    def points(self, candidate: Column) -> Column:
        """Evidence that a candidate is a name: of its first and last word, a title, and what comes before."""

        def best(patterns: tuple[str, ...], before: str, after: str) -> Column:
            found = F.lit(0)
            for n, pattern in enumerate(patterns, 1):
                found = F.when(candidate.rlike(f"{before}(?:{pattern}){after}"), n).otherwise(found)
            return found

        titled = F.when(candidate.rlike(rf"(?<!\p{{L}}){_TITLE}\s+\p{{Lu}}"), 3).otherwise(0)
        cued = F.when(F.lower(candidate).rlike(rf"(?<!\p{{L}})(?:{'|'.join(CUES)})[:,]?\s"), 1).otherwise(0)
        rest = rf"(?=\s+(?:\p{{Lu}}\.\s+)?{_WORD}(?:\s+{_WORD})?$)"
        return best(self.first, r"(?<!\p{L})", rest) + best(self.endings, r"\p{L}", "$") + titled + cued

    def detector(self, enough: int = ENOUGH) -> Detector:
        def named(text: Column) -> Column:
            return F.exists(F.regexp_extract_all(text, F.lit(_CANDIDATE), F.lit(0)), lambda c: self.points(c) >= enough)

        return lambda text: F.when(text.rlike(_PAIR), named(text)).otherwise(False)


def fit_names(names: DataFrame, texts: DataFrame, max_nodes: int = MAX_NODES, least: int = 2) -> NameModel:
    """A model of ``(name)``, full names as they are written, against ``(text)``, whatever else is written.

    Words are counted where they lie; at most ``max_nodes`` of each kind, found at least ``least`` times in names, reach the driver.
    """
    parts = F.regexp_extract_all("name", F.lit(_WORD), F.lit(0))
    split = names.select(parts.alias("parts")).where(F.size("parts") > 1)
    firsts = split.select(F.get("parts", F.lit(0)).alias("node"))
    lasts = split.select(F.element_at("parts", -1).alias("word"))
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    ends = F.array(*[F.when(F.length("word") > n, F.right("word", F.lit(n))) for n in _ENDINGS])

    def endings(df: DataFrame, n: Column) -> DataFrame:
        return df.select(F.explode(F.array_compact(ends)).alias("node"), n.alias("n"))

    return NameModel(
        _levels(firsts.select("node", F.lit(1).alias("n")), words.select(F.col("word").alias("node"), "n"), max_nodes, least),
        _levels(endings(lasts, F.lit(1)), endings(words, F.col("n")), max_nodes, least),
    )


def _levels(inside: DataFrame, outside: DataFrame, max_nodes: int, least: int) -> tuple[str, ...]:
    """Patterns of the nodes whose log-odds of being inside reach each level."""
    counted = inside.groupBy("node").agg(F.sum("n").alias("mine")).where(F.col("mine") >= least)
    other = outside.groupBy("node").agg(F.sum("n").alias("theirs"))
    sums = inside.agg(F.sum("n").alias("all_mine"), F.lit(1).alias("one")).join(outside.agg(F.sum("n").alias("all_theirs"), F.lit(1).alias("one")), "one")
    total = sums.first()
    if total is None or not total.all_mine:
        return tuple("(?!)" for _ in _LEVELS)
    rate = (F.col("mine") + 0.5) / float(total.all_mine)
    base = (F.coalesce("theirs", F.lit(0)) + 0.5) / float(total.all_theirs or 1)
    odds = counted.join(other, "node", "left").select("node", F.log(rate / base).alias("odds"))
    kept = odds.where(F.col("odds") >= _LEVELS[0]).orderBy(F.desc("odds"), "node").limit(max_nodes).collect()
    return tuple(trie_pattern(r.node for r in kept if r.odds >= level) for level in _LEVELS)


# --------------------------------------------------------------------------- addresses
_NUMBER = r"(?<![\p{L}\p{N}.,#/-])\p{Nd}{1,5}(?:[-–/]\p{Nd}{1,5})?\p{L}?"
_NAMED = rf"(?:{_WORD}|\p{{Lu}}\.|\p{{Nd}}{{1,3}}(?:st|nd|rd|th))"
_STREET = rf"{_NUMBER},?\s+(?:(?:North|South|East|West|N|S|E|W)\.?\s+)?(?:{_NAMED}\s+){{1,3}}(?:{'|'.join(STREETS)})(?!\p{{L}})\.?"
_STRASSE = rf"(?<!\p{{L}})\p{{Lu}}\p{{Ll}}+(?:stra(?:ß|ss)e|weg|platz|gasse|allee)\s+\p{{Nd}}{{1,4}}\p{{L}}?(?!\p{{L}})"
_RUE = rf"{_NUMBER},?\s+(?:bis\s+)?(?:rue|avenue|boulevard|place|calle|avenida|via)\s+(?:(?:de|du|des|la|le|les|del|los|las)\s+)*{_WORD}"
_CODE = r"(?:(?<!\p{L})\p{Lu}{1,2}\p{Nd}[\p{Lu}\p{Nd}]?\s?\p{Nd}\p{Lu}{2}(?!\p{L})|(?<!\p{N})\p{Nd}{4,5}(?:-\p{Nd}{4})?(?!\p{N}))"
_LINE = rf"(?:{_STREET}|{_STRASSE}|{_RUE})"
#: a street line; then, over at most three more parts, a postal code, or a locality after a comma or break
_WHOLE = rf"{_LINE}(?:(?:\s*,\s*|\s*\n\s*|\s+)(?:(?:{'|'.join(UNITS)})\s+\w{{1,5}}|{_WORD}(?:\s+{_WORD}){{0,2}}|\p{{Lu}}{{2,3}})){{0,3}}(?:\s*,\s*|\s*\n\s*|\s+){_CODE}"
_PLACED = rf"{_LINE}\s*(?:,|\n)\s*{_WORD}"
_UNIT = rf"(?<!\p{{L}})(?:{'|'.join(UNITS)})\s+\w{{1,5}},?\s+{_LINE}"
_BOX = r"(?i)(?<!\p{L})P\.?\s?O\.?\s?Box\s+\p{Nd}{1,6}(?!\p{N})"
#: what every street line holds, told without looking back and forth
_NUMBERED = r"[0-9]\p{L}?,?\s+(?:\p{L}|[0-9])|\p{L}\s+[0-9]"


def street_line(text: Column) -> Column:
    """A house number with a street; texts without a number next to a word skip the grammar."""
    return text.rlike(_NUMBERED) & text.rlike(_LINE)


def address(text: Column) -> Column:
    """A street line with a unit, locality or postal code, or a post-office box."""
    return (street_line(text) & (text.rlike(_WHOLE) | text.rlike(_PLACED) | text.rlike(_UNIT))) | text.rlike(_BOX)


ADDRESS_DETECTORS: dict[str, tuple[float, Detector]] = {"ADDRESS": (ADDRESS_SCORE, address), "STREET_LINE": (STREET_SCORE, street_line)}


def person_detector(model: NameModel) -> dict[str, tuple[float, Detector]]:
    return {"PERSON": (PERSON_SCORE, model.detector())}
