"""Unsafe-text predicates. Word lists are parameters; each list becomes one regular expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unsafe words by topic. Every row is one list of whole words; '.' inside a phrase
# stands for any single character, line breaks included.
HARMFUL_WORDS: dict[str, list[str]] = {
    "violence": [
        "hate|violence|harm|kill|murder|suicide|death|torture|abuse",
        "attack|assault|fight|beat|punch|kick|stab|shoot",
        "destroy|damage|hurt|injure|wound|pain",
    ],
    "discrimination": [
        "racist|sexist|homophobic|transphobic|xenophobic",
        "nazi|hitler|genocide|holocaust|supremacist",
    ],
    "weapons": [
        "bomb|weapon|explosive|terrorist|gun|rifle|pistol",
        "grenade|ammunition|firearm|knife|blade",
        "poison|toxic|chemical|biological",
    ],
    "illegal": [
        "drug|cocaine|heroin|meth|marijuana|cannabis",
        "illegal|criminal|fraud|theft|steal|rob",
        "hack|crack|piracy|counterfeit",
    ],
    "sexual": [
        "sexual|explicit|pornographic|nude|naked",
        "sex|porn|adult|erotic|intimate",
    ],
    "self_harm": [
        "self.harm|cut.myself|end.my.life|want.to.die",
        "depressed|hopeless|worthless|suicidal",
    ],
    "misinformation": [
        "conspiracy|hoax|fake.news|misinformation",
        "covid.hoax|vaccine.dangerous|flat.earth",
    ],
    "privacy": [
        "personal.information|social.security|credit.card",
        "password|private.key|confidential",
    ],
    "spam": [
        "click.here|buy.now|limited.time|act.fast",
        "guaranteed|miracle|secret|amazing.results",
    ],
}
# Word beginnings that are unsafe with any word ending.
HARMFUL_STEMS: list[str] = ["slur|derogatory|offensive|discriminat"]

# The five publishing checks, numbered from 1 in this order.
PUBLISHING_PATTERNS: list[str] = [
    r"\b(?:kill|murder|suicide|self-harm|violence)\b",
    r"\b(?:hate|racist|sexist|discriminat)\w*\b",
    r"\b(?:illegal|criminal|fraud|scam)\b",
    r"\b(?:drug|weapon|explosive|bomb)\b",
    r"\b(?:personal\s+information|private\s+data|ssn|credit\s+card)\b",
]


def _alternation(entries: Sequence[str]) -> str:
    """Alternatives grouped by first letter, so a word start is compared with few of them."""
    by_letter: dict[str, list[str]] = {}
    for entry in entries:
        by_letter.setdefault(entry[0], []).append(entry[1:])
    return "|".join(f"{letter}(?:{'|'.join(rests)})" for letter, rests in sorted(by_letter.items()))


def word_regex(words: Sequence[str], stems: Sequence[str] = ()) -> str:
    """One Unicode-aware expression that finds any of the words, or any word with such a stem.

    It expects lower-cased text. The first-letter test in front keeps the costlier word-boundary
    test away from most positions.
    """
    singles, open_ended = "|".join(words).split("|"), "|".join(stems).split("|") if stems else []
    parts = [_alternation(singles)]
    if open_ended:
        parts.append(f"(?:{_alternation(open_ended)})\\w*")
    letters = "".join(sorted({w[0] for w in [*singles, *open_ended]}))
    return rf"(?sU)(?=[{letters}])\b(?:{'|'.join(parts)})\b"


HARMFUL_REGEX = word_regex([row for rows in HARMFUL_WORDS.values() for row in rows], HARMFUL_STEMS)


def is_harmful_lowered(lowered: Column, regex: str = HARMFUL_REGEX) -> Column:
    """The same for a text that is in lower case already."""
    return F.coalesce(lowered.rlike(regex), F.lit(False))


def is_harmful(text: Column, regex: str = HARMFUL_REGEX) -> Column:
    """True when the text holds an unsafe word. NULL text is harmless."""
    return is_harmful_lowered(F.lower(text), regex)


def publishing_issues(text: Column, patterns: Sequence[str] = tuple(PUBLISHING_PATTERNS)) -> Column:
    """Numbers (from 1) of the publishing checks that the text fails."""
    hits = [F.when(text.rlike(f"(?iU){p}"), F.lit(n)) for n, p in enumerate(patterns, start=1)]
    return F.array_compact(F.array(*hits))
