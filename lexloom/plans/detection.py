"""Layer 4 of the cascade: what outside libraries say about words that no rule decides.

A step is a function from a word to True (delete), False (keep) or None (cannot tell). Steps are asked in order until one
can tell; the language detector comes first, names and word forms only where it fails. Libraries that are not installed
give no step, and without any step undecided words stay.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from lexloom.config import DEFAULT, Config

Step = Callable[[str], "bool | None"]


def _installed(*names: str) -> bool:
    return all(importlib.util.find_spec(n) is not None for n in names)


def language_step(language: str) -> Step:
    """Whether the detected language is ``language``. Seeded, so that the same word always gets the same answer."""

    def ask(word: str) -> bool | None:
        import langdetect

        langdetect.DetectorFactory.seed = 0
        try:
            found = langdetect.detect(word)
        except langdetect.LangDetectException:
            return None
        return found == language if found else None

    return ask


def name_step() -> Step:
    """Russian personal names are deleted."""
    made: list = []

    def ask(word: str) -> bool | None:
        import natasha

        if not made:
            made.append(natasha.NamesExtractor(natasha.MorphVocab()))
        return True if list(made[0](word)) else None

    return ask


def form_step() -> Step:
    """Words with a known Russian parse whose base form differs are deleted."""
    made: list = []

    def ask(word: str) -> bool | None:
        import pymorphy2

        if not made:
            made.append(pymorphy2.MorphAnalyzer())
        known = [p for p in made[0].parse(word) if "UNKN" not in str(p.tag)]
        return True if any(p.normal_form != word.lower() for p in known) else None

    return ask


def chain(*steps: Step) -> Callable[[str], bool]:
    """Whether the first step that can tell deletes the word."""

    def delete(word: str) -> bool:
        for step in steps:
            verdict = step(word)
            if verdict is not None:
                return verdict
        return False

    return delete


def detector(config: Config = DEFAULT) -> Callable[[str], bool] | None:
    """The steps whose libraries are installed, as one function; None if there are none."""
    steps = []
    if _installed("langdetect"):
        steps.append(language_step(config.primary_language))
    if _installed("natasha"):
        steps.append(name_step())
    if _installed("pymorphy2"):
        steps.append(form_step())
    return chain(*steps) if steps else None
