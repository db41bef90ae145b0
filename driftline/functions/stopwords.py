"""Stop words, from the lists in the folder ``words``."""

from __future__ import annotations

import os

# The languages whose lists are joined for channel names, and the
# one used for message topics.
NAME_LANGUAGES = ("italian", "english", "russian", "german", "spanish", "french")
TOPIC_LANGUAGES = ("italian",)

FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "words")


def stop_words(languages=NAME_LANGUAGES) -> list[str]:
    """Distinct words of all ``languages``, sorted."""
    words: set[str] = set()
    for language in languages:
        with open(os.path.join(FOLDER, f"{language}.txt"), encoding="utf-8") as lines:
            words.update(lines.read().splitlines())
    return sorted(words)
