"""Plain-Python forms that the operators are held against; none uses the operators' own code."""

import hashlib
import math
import re
from collections import Counter

import numpy as np


def clash(df):
    """The same rows with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = (
        "id", "text_", "keys", "size", "rep", "component", "score", "share", "rank", "block", "h1", "n", "th", "row", "rate", "topic", "tokens", "__topic", "__tokens", "label", "lead", "key", "same", "conv", "msg",
        "cell", "held_out", "a", "b", "comp", "body", "level", "raw", "dim", "axis", "tile",
    )
    return df.withColumns({c: F.lit(1) for c in names if c not in df.columns})


def words(text):
    """Runs of ASCII letters, digits, underscores and non-ASCII characters; of more than 1,024 bytes, in parts."""
    out = []
    for w in re.findall("[0-9A-Za-z_\u0080-\U0010ffff]+", (text or "").lower()):
        raw = w.encode()
        out += [raw[i : i + 1024] for i in range(0, len(raw), 1024)]
    return out


def shingles(text, width=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else Counter([tuple(w)])


WEIGHT = {"set": lambda c: 1.0, "log": lambda c: 1 + math.log(c), "count": float}


def similarity(a, b, weight="log"):
    """Weighted Jaccard similarity of two texts' shingles; 0 without any."""
    x, y = ({k: WEIGHT[weight](c) for k, c in shingles(t).items()} for t in (a, b))
    both = sum(min(v, y[k]) for k, v in x.items() if k in y)
    every = sum(x.values()) + sum(y.values()) - both
    return both / every if every else 0.0


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near(ids, texts, threshold=0.8, weight="log"):
    """The component of each id by comparing all pairs of rows; rows of one id are one node."""
    sets = [{k: WEIGHT[weight](c) for k, c in shingles(t).items()} for t in texts]
    total = [sum(s.values()) for s in sets]
    links = []
    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and min(total[i], total[j]) >= threshold * max(total[i], total[j]) * (1 - 1e-9):
                a, b = sorted((sets[i], sets[j]), key=len)
                both = sum(min(v, b[k]) for k, v in a.items() if k in b)
                if both >= threshold * (total[i] + total[j] - both):
                    links.append((ids[i], ids[j]))
    return components(ids, links)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rng(seed=1):
    return np.random.default_rng(seed)


def peak_mb(code, lines=""):
    """Run code in a fresh interpreter; the growth of its memory over what lines, run before it, took."""
    import subprocess
    import sys

    script = f"import resource\n{lines}\nm = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n{code}\nprint((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - m) / 1024)"
    got = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, check=True)
    return float(got.stdout.split()[-1])
