"""Plain versions of operators that several tests hold results against."""

import math
import re
import zlib
from collections import Counter, defaultdict


def language_model(rows, words=100_000, grams=20_000):
    """Scores of ``(doc_id, text, lang)`` rows outside the held-out fold: word and n-gram counts by
    language, each language's own most frequent ones, smoothed; longest known n-grams of unseen words."""
    counts = defaultdict(Counter)
    for i, text, lang in rows:
        if i is None or text is None or lang is None or zlib.crc32(str(i).encode()) % 4 == 2:
            continue
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            if len(w) <= 64:
                counts[lang, 0][w] += 1
            for n in range(1, 5):
                counts[lang, n].update(f"<{w}>"[k:k + n] for k in range(len(w) + 3 - n))
    langs = sorted({lang for lang, _ in counts})
    known = {n: {k for lang in langs for k, _ in sorted(counts[lang, n].items(), key=lambda x: (-x[1], x[0].encode()))[:(grams if n else words) // len(langs)]}
             for n in range(5)}

    def log_frequency(n, key):
        return [math.log((counts[lang, n][key] + 0.5) / (sum(counts[lang, n].values()) + 0.5 * (len(known[n]) + 1))) for lang in langs]

    def of_word(w):
        if w in known[0]:
            return log_frequency(0, w)
        for n in range(4, 0, -1):
            hits = [log_frequency(n, g) for k in range(len(w) + 3 - n) if (g := f"<{w}>"[k:k + n]) in known[n]]
            if hits:
                return [sum(x) / len(hits) for x in zip(*hits)]
        return [0.0] * len(langs)

    def predict(text):
        said = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not langs or not any(c.isalpha() for w in said for c in w):
            return "und", 0.0
        memo = {w: of_word(w) for w in set(said)}
        total = [sum(memo[w][j] for w in said) / len(said) * min(len(said), 12.0) for j in range(len(langs))]
        p = [math.exp(x - max(total)) for x in total]
        best = max(range(len(langs)), key=lambda j: p[j])
        return langs[best], p[best] / sum(p)

    return predict
