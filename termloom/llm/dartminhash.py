"""MinHash near-duplicates by DartMinHash: darts thrown at weighted element regions.

Every element e (a distinct shingle) owns the region [0, weight) x time. The weight axis is cut
into cells, [0, 1), [1, 3), [3, 7) and so on. Darts fall on a cell as a Poisson process whose
times, heights and coordinates depend on the element and the cell alone; an element takes the
darts whose height is under its weight. A coordinate keeps the earliest dart thrown at any
element of the document, so two documents agree on a coordinate with the probability of their
weighted Jaccard similarity, sum of minima over sum of maxima. Only darts before a time limit of
about ln(coordinates) / total weight are thrown; documents with a coordinate still empty get a
later limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._components import components
from ._spark import cut, integer_id
from ._text import U64, mix, release, shingle_counts

WIDTH, THRESHOLD, BANDS, ROWS = 5, 0.8, 24, 5
#: What a shingle that a document holds c times weighs in it.
WEIGHTS = {"set": lambda c: np.ones(len(c)), "log": lambda c: 1 + np.log(c), "count": lambda c: c.astype(np.float64)}
#: Weight and documents of a block of documents that are compared in one task.
BLOCK, BLOCK_ROWS = 500_000, 1024
#: Pairs of one representative that are verified in one part.
HOT = 512
#: Elements that darts are thrown at in one go.
THROW = 1 << 20
_LAST = (1 << 63) - 1


def _unit(h: np.ndarray) -> np.ndarray:
    """A number in (0, 1] from a hash."""
    return ((h >> U64(11)).astype(np.float64) + 1.0) * 2.0**-53


def _throw(doc: np.ndarray, elements: np.ndarray, weights: np.ndarray, limit: np.ndarray, coordinates: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, time, hash) of the darts that hit the elements before their documents' limits."""
    cells = np.maximum(1, np.ceil(np.log2(weights + 1))).astype(np.int64)
    rep = np.repeat(np.arange(len(doc)), cells)
    cell = np.arange(len(rep)) - np.repeat(np.cumsum(cells) - cells, cells)
    wide = np.exp2(cell)
    d, top, end = doc[rep], weights[rep] - (wide - 1), limit[doc[rep]]
    s = mix(elements[rep] + cell.astype(U64) * U64(0xD1342543DE82EF95))
    t, found, i = np.zeros(len(rep)), [], 0
    while len(rep):
        i += 1
        h = mix(s + U64(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        t = t - np.log(_unit(h)) / (coordinates * wide)
        on = t < end
        d, s, t, h, wide, top, end = d[on], s[on], t[on], h[on], wide[on], top[on], end[on]
        hit = _unit(mix(h + U64(0xA0761D6478BD642F))) * wide <= top
        found.append((d[hit], t[hit], h[hit]))
        rep = d
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (d, t, s)


def darts(docs: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_docs: int, coordinates: int) -> np.ndarray:
    """Signatures (n_docs x coordinates, uint64; zeros for documents without elements).

    docs, elements, weights: the sparse rows, one for each distinct element of a document;
    weights are positive numbers, of the order of 1 or more.
    """
    sign = np.zeros((n_docs, coordinates), U64)
    weights = weights.astype(np.float64)
    total = np.bincount(docs, weights, n_docs)
    limit = np.where(total > 0, (np.log(coordinates) + 3) / np.maximum(total, 1e-300), 0.0)
    open_docs = total > 0
    while open_docs.any():
        live = np.flatnonzero(open_docs[docs])
        thrown = [_throw(docs[x], elements[x], weights[x], limit, coordinates) for x in (live[at : at + THROW] for at in range(0, len(live), THROW))]
        fd, ft, fh = (np.concatenate(x) for x in zip(*thrown, strict=True))
        place = fd * coordinates + (mix(fh) % U64(coordinates)).astype(np.int64)
        order = np.lexsort((ft, place))
        place, fh = place[order], fh[order]
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        flat = np.zeros(n_docs * coordinates, U64)
        flat[place[first]] = fh[first] | U64(1)
        got = flat.reshape(n_docs, coordinates)
        full = open_docs & (got > 0).all(axis=1)
        sign[full] = got[full]
        open_docs &= ~full
        limit = limit * 1.7
    return sign


def band_keys(sign: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    out = np.zeros((len(sign), bands), U64)
    for b in range(bands):
        acc = np.full(len(sign), b + 1, U64)
        for r in range(rows):
            acc = mix(acc + sign[:, b * rows + r])
        out[:, b] = acc
    return out


def _row(text: str, width: int, weight: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, weights) of a text's distinct shingles, by hash."""
    for _, _, (_, hashes, counts) in shingle_counts([text], width):
        return hashes, WEIGHTS[weight](counts)
    return np.zeros(0, U64), np.zeros(0)


def _sketches(batches, width: int, bands: int, rows: int, weight: str):
    for batch in batches:
        n_col, th_col, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        for lo, hi, (docs, hashes, counts) in shingle_counts(texts, width, most=256):
            n = hi - lo
            w = WEIGHTS[weight](counts)
            keys = band_keys(darts(docs, hashes, w, n, bands * rows), bands, rows)
            size = np.bincount(docs, w, n).astype(np.float64)
            same = np.zeros(n, U64)
            np.add.at(same, docs, mix(hashes + (U64(0) if weight == "set" else counts.astype(U64))))
            yield pa.RecordBatch.from_arrays(
                [n_col.slice(lo, n), th_col.slice(lo, n), pa.array(size), pa.array(same.view(np.int64)), pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))],
                names=["n", "th", "size", "same", "keys"],
            )
        del n_col, th_col, texts, batch
        release()


def _similar(batches, width: int, weight: str):
    """Exact weighted Jaccard similarity of the two texts of each row."""
    last, kept = None, None
    for batch in batches:
        ids = [batch.column(i) for i in range(4)]
        b = list(zip(ids[2].to_pylist(), ids[3].to_pylist(), strict=True))
        ta, tb = batch.column(4), batch.column(5)
        share = np.zeros(len(b))
        for i in range(len(b)):
            if last != b[i]:
                last, kept = b[i], _row(tb[i].as_py(), width, weight)
            h, w = _row(ta[i].as_py(), width, weight)
            _, x, y = np.intersect1d(h, kept[0], assume_unique=True, return_indices=True)
            both = np.minimum(w[x], kept[1][y]).sum()
            share[i] = both / (w.sum() + kept[1].sum() - both)
        yield pa.RecordBatch.from_arrays([*ids, pa.array(share)], names=["an", "ath", "bn", "bth", "share"])
        del ta, tb, batch
        release()


def _overlaps(rows: list[tuple], left: np.ndarray, right: np.ndarray, size: np.ndarray, threshold: float, eligible: np.ndarray, dense: bool):
    """(i, j) of the eligible pairs left x right with a weighted Jaccard similarity of at least threshold.

    dense: first find by one product of 0/1 columns how many shingles a pair shares, and leave
    out the pairs that can't reach the threshold with the largest weights of those.
    """
    i, j = np.nonzero(eligible)
    if dense and len(i) > 4096:
        doc = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        top = np.array([r[1].max(initial=0.0) for r in rows])
        _, column, times = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True, return_counts=True)
        common = times[column] > 1
        order = np.argsort(column[common], kind="stable")
        doc, column = doc[common][order], np.unique(column[common][order], return_inverse=True)[1]
        shared = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            part = slice(*np.searchsorted(column, [at, at + 2048]))
            flat = np.zeros((len(rows), 2048), np.float32)
            flat[doc[part], column[part] - at] = 1
            shared += flat[left] @ flat[right].T
        most = shared[i, j] * np.minimum(top[left[i]], top[right[j]])
        some = most * (1 + threshold) * (1 + 1e-5) >= threshold * (size[left[i]] + size[right[j]])
        i, j = i[some], j[some]
    both = np.zeros(len(i))
    for n, (x, y) in enumerate(zip(left[i], right[j], strict=True)):
        _, u, v = np.intersect1d(rows[x][0], rows[y][0], assume_unique=True, return_indices=True)
        both[n] = np.minimum(rows[x][1][u], rows[y][1][v]).sum()
    ok = both >= threshold * (size[left[i]] + size[right[j]] - both)
    return left[i[ok]], right[j[ok]]


def _block(table: pa.Table, width: int, weight: str, threshold: float) -> pa.Table:
    """Links between the documents of two blocks (or within one) of a bucket, each tested once.

    Pairs of one component need no test; a pair that shares several buckets is left to the first.
    """
    n, th, comp = table["n"].to_numpy(), table["th"].to_numpy(), table["comp"].to_numpy()
    p, q, mine = table["p"][0].as_py(), table["q"][0].as_py(), np.array(table["mine"].to_pylist())
    left, right = np.flatnonzero(mine == p), np.flatnonzero(mine == q)
    key = table["key"][0].as_py()
    keys = np.stack(table["keys"].to_numpy())
    band = int(np.flatnonzero(keys[0] == key)[0])
    rows = [_row(t.as_py(), width, weight) for t in table["text"]]
    size = np.array([r[1].sum() for r in rows], np.float64)
    found = [np.zeros((0, 2), np.int64)]
    for at in range(0, len(left), 1024):
        l = left[at : at + 1024]
        x, y = size[l][:, None], size[right][None, :]
        eligible = (comp[l][:, None] != comp[right][None, :]) & (np.minimum(x, y) >= threshold * np.maximum(x, y) * (1 - 1e-9))
        if p == q:
            eligible &= l[:, None] > right[None, :]
        for b in range(band):
            eligible &= keys[l, b][:, None] != keys[right, b][None, :]
        found.append(np.column_stack(_overlaps(rows, l, right, size, threshold, eligible, True)))
    a, b = np.concatenate(found).T
    release()
    return pa.table({"an": pa.array(n[a]), "ath": pa.array(th[a]), "bn": pa.array(n[b]), "bth": pa.array(th[b])})


def _as(side: str, *names: str) -> list[Column]:
    return [F.col(x).alias(f"{side}{x}") for x in names]


def verified(pairs: DataFrame, texts: DataFrame, width: int, weight: str) -> DataFrame:
    """pairs (an, ath, bn, bth) with their exact similarity; texts (n, th, text), one row for each (n, th).

    The pairs leave the join ordered by b, so a much-used b is shingled once for a run of rows.
    A b with more than HOT pairs is salted: its pairs are dealt to parts, its text to each part.
    """
    b = ["bn", "bth"]
    hot = pairs.groupBy(*b).agg(F.ceil(F.count("*") / HOT).cast("int").alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    salted = pairs.join(hot, b, "left").select("an", "ath", *b, F.pmod(F.xxhash64("an", "ath"), parts).cast("int").alias("salt"))
    ta, tb = (texts.select(*_as(s, "n", "th"), F.col("text").alias(f"t{s}")) for s in "ab")
    tb = tb.join(pairs.select(*b).distinct(), b, "left_semi").join(hot, b, "left").select(*b, "tb", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    both = salted.join(ta, ["an", "ath"]).join(tb, [*b, "salt"]).select("an", "ath", *b, "ta", "tb")
    return both.mapInArrow(lambda it: _similar(it, width, weight), "an long, ath long, bn long, bth long, share double")


def _node(side: str) -> Column:
    return F.struct(F.col(f"{side}n").alias("n"), F.col(f"{side}th").alias("th"))


def _edges(df: DataFrame) -> DataFrame:
    return df.select(_node("a").alias("a"), _node("b").alias("b"))


def _text_of(rows: DataFrame, named: DataFrame) -> DataFrame:
    """(n, th, text) of the named nodes, one row for each; rows that repeat are combined before the shuffle."""
    return rows.join(named, ["n", "th"], "left_semi").groupBy("n", "th").agg(F.max("text").alias("text"))


def links(rows: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, bands: int = BANDS, per_band: int = ROWS, weight: str = "log") -> tuple[DataFrame, DataFrame]:
    """(links, nodes) of rows (n, th, text): n an id, th a hash of the text, so (n, th) names a text.

    links: (a, b), structs of n and th; with them the components are those of all pairs of texts
    whose similarity reaches threshold. nodes: (n, th, ...), one row for each row with a word.
    """
    sketch = cut(rows.mapInArrow(lambda it: _sketches(it, width, bands, per_band, weight), "n long, th long, size double, same long, keys array<long>").where("size > 0"))
    # exact copies: one representative text each; equal shingles give equal keys
    groups = sketch.groupBy("same", "size", "keys").agg(F.min("n").alias("rn"), F.min_by("th", "n").alias("rth"))
    classes = cut(groups.select(F.col("rn").alias("n"), F.col("rth").alias("th"), "size", "keys", "same"))
    first_key = F.col("keys")[0].alias("first_key")
    of = classes.select("same", "size", first_key, *_as("b", "n", "th"))
    copies = sketch.select("same", "size", first_key, *_as("a", "n", "th")).join(of, ["same", "size", "first_key"]).where("an <> bn or ath <> bth")
    spread_keys = classes.select("n", "th", "size", F.explode("keys").alias("key"))
    # written before it is joined, so that a bucket with very many members can be split in the join
    leads = cut(spread_keys.groupBy("key").agg(F.min("n").alias("ln"), F.min_by("th", "n").alias("lth"), F.count("*").alias("members")).where("members > 1").select("key", "ln", "lth"))
    members = cut(spread_keys.join(leads, "key").where("n <> ln or th <> lth"))
    size_of = classes.select(F.col("n").alias("ln"), F.col("th").alias("lth"), F.col("size").alias("lead_size"))
    fits = F.least("size", "lead_size") >= F.lit(threshold * (1 - 1e-9)) * F.greatest("size", "lead_size")
    stars = members.select("n", "th", "ln", "lth", "size").distinct().join(size_of, ["ln", "lth"]).where(fits)
    stars = cut(stars.select(*_as("a", "n", "th"), F.col("ln").alias("bn"), F.col("lth").alias("bth")))
    named = stars.select(F.col("an").alias("n"), F.col("ath").alias("th")).union(stars.select("bn", "bth")).distinct()
    tested = cut(verified(stars, _text_of(rows, named), width, weight))
    linked = _edges(tested.where(F.col("share") >= threshold))
    comp = components(linked).select(F.col("id.n").alias("n"), F.col("id.th").alias("th"), F.xxhash64("component").alias("comp"))
    # what the stars leave open: members of a bucket in different components, tested in blocks.
    # Sizes that differ by more than the threshold allows are never compared, so blocks are made
    # within classes of size and paired with the same class and the next one.
    sized = F.floor(F.log("size") / F.lit(float(-np.log(threshold)) * (1 + 1e-9)) if threshold < 1 else F.col("size")).cast("long")
    at = members.join(comp, ["n", "th"], "left").withColumn("comp", F.coalesce("comp", F.xxhash64(F.struct("n", "th")))).withColumn("cls", sized)
    wide = at.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    at = cut(at.join(wide, "key", "left_semi").select("key", "n", "th", "size", "comp", "cls"))
    parts = at.groupBy("key", "cls").agg(F.greatest(F.ceil(F.sum("size") / BLOCK), F.ceil(F.count("*") / BLOCK_ROWS)).cast("int").alias("parts"))
    mine = F.struct("cls", F.pmod(F.xxhash64("n", "th"), F.col("parts")).cast("int").alias("part"))
    at = at.join(parts, ["key", "cls"]).withColumn("mine", mine)
    near = parts.select("key", F.col("cls").alias("near"), F.col("parts").alias("others"))
    spread = at.withColumn("near", F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1))).join(near, ["key", "near"])
    other = F.struct(F.col("near").alias("cls"), F.col("other").alias("part"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    spread = cut(spread.select("key", F.least(F.col("mine"), other).alias("p"), F.greatest(F.col("mine"), other).alias("q"), "mine", "n", "th", "comp"))
    group = ["key", "p", "q"]
    open_ = spread.groupBy(*group).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select(*group)
    spread = cut(spread.join(open_, group, "left_semi"))
    texts = _text_of(rows, spread.select("n", "th").distinct()).join(classes.select("n", "th", "keys"), ["n", "th"])
    blocks = spread.join(texts, ["n", "th"])
    more = blocks.groupBy(*group).applyInArrow(lambda t: _block(t, width, weight, threshold), "an long, ath long, bn long, bth long")
    return linked.union(_edges(more)).union(_edges(copies)), sketch


def _rows(df: DataFrame, n: Column, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return df.select(n.alias("n"), F.xxhash64(text).alias("th"), text.alias("text")).where("n is not null and text is not null")


def near_duplicates(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, weight: str = "log"
) -> DataFrame:
    """(id_col, component_id, kept) for each row of df.

    component_id is the smallest id reachable over links; a link joins two documents whose
    weighted Jaccard similarity over shingles of width words is at least threshold; a shingle
    that a document holds c times weighs 1 + ln c (weight="log"), 1 ("set") or c ("count"). kept
    marks the component's smallest id. Candidates come from equal bands of the DartMinHash
    signatures (0.01 % of links at the very threshold are missed with the defaults, fewer above
    it) and are checked exactly.

    Null or empty texts and texts without words link with nothing. Rows with a null id come
    back with a null component and kept true. Rows that repeat an id are one document with
    several texts: whatever any of them links to belongs to the id's component, and all its rows
    are returned. Ids must be integers. Other columns of df play no part.
    """
    own = integer_id(df, id_col)
    found, _ = links(_rows(df, own, text_col), width=width, threshold=threshold, bands=bands, per_band=rows, weight=weight)
    comp = components(found.select(F.col("a.n").alias("a"), F.col("b.n").alias("b")))
    out = df.select(own.alias("id")).join(comp, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def representatives(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of df, columns unchanged, that stay: one row of each group of near-duplicate texts.

    Texts are compared row by row, whatever their ids: rows that repeat an id with different
    texts are different documents, rows that repeat an id and its text, or have a null id, are
    copies as any others. Of a group the row with the smallest id stays (null ids last); of rows
    that agree in id and text, the smallest in the order of the columns, so columns must have an
    order. Rows whose text is null or has no word link with nothing and all stay.
    """
    n = F.coalesce(integer_id(df, id_col), F.lit(_LAST))
    found, nodes = links(_rows(df, n, text_col), **how)
    comp = components(found)
    gone = comp.where("id <> component").select(F.col("id.n").alias("n"), F.col("id.th").alias("th"))
    often = nodes.groupBy("n", "th").agg(F.count("*").alias("times")).where("times > 1").select("n", "th")
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), n.alias("n"), F.xxhash64(F.col(text_col)).alias("th"))
    row = row.join(gone, ["n", "th"], "left_anti")
    single = row.join(often, ["n", "th"], "left_anti").select("row")
    repeated = row.join(often, ["n", "th"], "left_semi").groupBy("n", "th").agg(F.min("row").alias("row")).select("row")
    return single.union(repeated).select("row.*")
