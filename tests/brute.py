"""The same answers in plain Python, for comparison."""

from collections import Counter


def words_of(content):
    kept = "".join(c for c in content.lower() if c == " " or "a" <= c <= "z")
    return kept.split()


def frequencies_of(rows):
    """One (filename, word, n) per record and distinct word."""
    return sorted(
        (filename, word, n)
        for filename, content in rows
        for word, n in Counter(words_of(content)).items()
    )


def peaks_of(rows):
    """word -> (filename, n): highest n, then smallest filename in byte order."""
    candidates = {}
    for filename, word, n in frequencies_of(rows):
        candidates.setdefault(word, []).append((-n, filename.encode(), filename))
    best = {word: min(found) for word, found in candidates.items()}
    return {word: (filename, -negated) for word, (negated, _, filename) in best.items()}
