"""How the sources of a language differ: divergences between them, and the terms that stand out."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitscope.storage import written

# Bytes of words, in texts whose A-Z became a-z: letters, and every byte of characters beyond ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")
LOWER = bytes(c + 32 if ord("A") <= c <= ord("Z") else c for c in range(256))
SLICE = 1 << 20
UNIT_WORDS = 2_000_000
SHARD_BYTES = 32_000_000
SPLIT = 32_000  # a divisor of the scale: two short divisions take the place of a long one

UNIT = "lang string, shard int, terms binary, documents binary, entries binary, sources array<string>"
COUNT = "lang string, shard int, term string, source string, n long"
FOUND = "lang string, source string, part string, item string, value long"


def pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers, first all their lowest bytes, then the next."""
    planes = np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return planes.reshape(8, -1).T.copy().view("<i8").reshape(-1)


def summed(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of each one's numbers."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(numbers[order], starts) if len(starts) else numbers[:0]


def slices(text: bytes) -> Iterator[bytes]:
    """The text in slices of about a megabyte that cut no term."""
    at = 0
    while len(text) - at > SLICE:
        end = at + SLICE
        inside = TERM.match(text, end)
        end = inside.end() if inside else end
        yield text[at:end]
        at = end
    yield text[at:]


class Unit:
    """What some texts of a language add up to: documents and occurrences by source of each term."""

    def __init__(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.sources: dict[str, int] = {}
        self.places: list[np.ndarray] = []  # of terms, and how often each occurs, text by text
        self.times: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.copies: list[tuple[list[int], list[int]]] = []
        self.words = 0

    def add(self, text: str, sources: list[str], copies: list[int]) -> None:
        known, parts = self.terms, []
        for part in slices(text.encode("utf-8", "surrogatepass").translate(LOWER)):
            found = [known.setdefault(term, len(known)) for term in TERM.findall(part)]
            parts.append(np.unique(np.array(found, np.int64), return_counts=True))
        places, times = parts[0] if len(parts) == 1 else summed(*map(np.concatenate, zip(*parts)))
        if len(places):
            self.places.append(places)
            self.times.append(times)
            self.sizes.append(len(places))
            self.copies.append(([self.sources.setdefault(s, len(self.sources)) for s in sources], copies))
            self.words += len(places) * len(sources)

    def rows(self, lang: str, shards: int) -> Iterator[tuple]:
        """A row for each shard of the terms."""
        if not self.terms:
            return
        places, times = np.concatenate(self.places), np.concatenate(self.times)
        sizes = np.array(self.sizes)
        documents = np.zeros(len(self.terms), np.int64)
        np.add.at(documents, places, np.repeat([sum(n) for _, n in self.copies], sizes))
        # A text counts for each source that has it, as often as it does.
        having = np.array([len(sources) for sources, _ in self.copies])
        source = np.concatenate([sources for sources, _ in self.copies])
        copies = np.concatenate([n for _, n in self.copies])
        ends = np.cumsum(sizes)
        each = np.repeat(sizes, having)
        within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        entry = np.repeat(np.repeat(ends - sizes, having), each) + within
        keys, n = summed(
            places[entry] * len(self.sources) + np.repeat(source, each), times[entry] * np.repeat(copies, each)
        )
        term, source = np.divmod(keys, len(self.sources))
        listed = list(self.terms)
        shard_of = np.array([zlib.crc32(t) % shards for t in listed])
        order = np.argsort(shard_of, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        by_rank = np.argsort(rank[term], kind="stable")
        term, source, n = rank[term][by_rank], source[by_rank], n[by_rank]
        present = np.unique(shard_of)
        firsts = np.searchsorted(shard_of[order], present)
        for shard, a, b in zip(present.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(order)]):
            lo, hi = np.searchsorted(term, [a, b])
            names = zstandard.ZstdCompressor(level=1).compress(b"\n".join(listed[i] for i in order[a:b]))
            entries = pack(np.concatenate([term[lo:hi] - a, source[lo:hi], n[lo:hi]]))
            yield lang, shard, names, pack(documents[order[a:b]]), entries, list(self.sources)


def counter(shards: int):
    """What the texts of a task add up to, in rows of packed columns, one for each shard."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: dict[str, Unit] = {}

        def batch_of(rows: Iterator[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string())]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            names = ["lang", "shard", "terms", "documents", "entries", "sources"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for lang, text, copies in zip(*(batch.column(i).to_pylist() for i in range(3))):
                unit = units.setdefault(lang, Unit())
                unit.add(text, [c["source"] for c in copies], [c["n"] for c in copies])
                if unit.words > UNIT_WORDS:
                    yield batch_of(units.pop(lang).rows(lang, shards))
            if sum(unit.words for unit in units.values()) > UNIT_WORDS:
                largest = max(units, key=lambda lang: units[lang].words)
                yield batch_of(units.pop(largest).rows(largest, shards))
        for lang, unit in units.items():
            yield batch_of(unit.rows(lang, shards))

    return count


def merger(least_documents: int):
    """The counts of a shard's kept terms: a row for each source, and one without for them all."""

    def merge(units: pa.Table) -> pa.Table:
        columns = {name: units.column(name).to_pylist() for name in units.column_names}
        texts = (zstandard.ZstdDecompressor().decompress(data).split(b"\n") for data in columns["terms"])
        codes: dict[bytes, int] = {}
        sources: dict[str, int] = {}
        documents, keys, numbers = [], [], []
        for terms, held, entries, names in zip(
            texts, columns["documents"], columns["entries"], columns["sources"]
        ):
            code = np.array([codes.setdefault(term, len(codes)) for term in terms])
            source = np.array([sources.setdefault(name, len(sources)) for name in names])
            documents.append((code, unpack(held)))
            term, own, n = unpack(entries).reshape(3, -1)
            keys.append((code[term], source[own]))
            numbers.append(n)
        total = np.zeros(len(codes), np.int64)
        for code, held in documents:
            total[code] += held  # no term stands twice in a unit
        term, source = (np.concatenate(part) for part in zip(*keys))
        n = np.concatenate(numbers)
        kept = total[term] >= least_documents
        own, own_n = summed(term[kept] * len(sources) + source[kept], n[kept])
        all_, all_n = summed(term[kept], n[kept])
        listed, names = pa.array(list(codes), pa.binary()).cast(pa.string()), pa.array(list(sources), pa.string())
        own_term, own_source = np.divmod(own, len(sources))
        size = len(own) + len(all_)
        return pa.table(
            {
                "lang": pa.array([columns["lang"][0]] * size, pa.string()),
                "shard": pa.array([columns["shard"][0]] * size, pa.int32()),
                "term": listed.take(pa.array(np.concatenate([own_term, all_]), pa.int64())),
                "source": pa.concat_arrays([names.take(pa.array(own_source, pa.int64())), pa.nulls(len(all_), pa.string())]),
                "n": pa.array(np.concatenate([own_n, all_n]), pa.int64()),
            }
        )

    return merge


def shares(n: np.ndarray, whole: np.ndarray, smoothing: int, scale: int) -> np.ndarray:
    """1 + floor(scale * (n + smoothing) / whole), exact while ``whole`` is below 2.8e14."""
    upper, rest = np.divmod((n + smoothing) * SPLIT, whole)
    return 1 + upper * (scale // SPLIT) + rest * (scale // SPLIT) // whole


def divergences(term, source, share, absent, n_terms: int) -> Iterator[np.ndarray]:
    """For each source, the sums of abs(p - q) over all terms with every source.

    ``term``, ``source`` and ``share`` list the entries that are not zero, by source and then term;
    ``absent`` is each source's share of a term that it does not have. A source is laid out over all
    terms; others differ from their ``absent`` at their entries only.
    """
    starts = np.searchsorted(source, np.arange(len(absent) + 1))
    owners = np.flatnonzero(starts[1:] > starts[:-1])
    for s in range(len(absent)):
        own = np.full(n_terms, absent[s])
        held = share[starts[s] : starts[s + 1]]
        own[term[starts[s] : starts[s + 1]]] = held
        # The sums against each absent share, by the sums of the smaller and of the larger values.
        ordered = np.sort(held)
        so_far = np.r_[0, np.cumsum(ordered)]
        below = np.searchsorted(ordered, absent)
        sums = absent * (2 * below - len(held)) - 2 * so_far[below] + so_far[-1]
        sums += (n_terms - len(held)) * np.abs(absent[s] - absent)
        change = np.abs(own[term] - share) - np.abs(own[term] - absent[source])
        if len(owners):
            sums[owners] += np.add.reduceat(change, starts[owners])
        yield sums


def evaluator(smoothing: int, scale: int, most_terms: int):
    """A shard's part of all divergences of a language, and its terms that may stand out most."""

    def evaluate(counts: pa.Table, heads: pa.Table) -> pa.Table:
        lang = heads.column("lang")[0].as_py()
        names, n_all = heads.column("source").to_pylist(), heads.column("n_all").to_numpy()
        n_terms, n_lang = (heads.column(name)[0].as_py() for name in ("n_terms", "n_lang"))
        whole = n_all + smoothing * n_terms
        rows: list[tuple] = []

        def add(part: str, source: str, items: list[str], values: list[int]) -> None:
            rows.append(([lang] * len(items), [source] * len(items), [part] * len(items), items, values))

        if counts.num_rows:
            listed = counts.column("term").combine_chunks().dictionary_encode()
            terms, codes = listed.dictionary.to_pylist(), listed.indices.to_numpy()
            place = {name: i for i, name in enumerate(names)}
            source = np.array([-1 if s is None else place[s] for s in counts.column("source").to_pylist()])
            order = np.lexsort((codes, source))
            codes, source, n = codes[order].astype(np.int64), source[order], counts.column("n").to_numpy()[order]
            first = np.searchsorted(source, 0)
            in_lang = np.zeros(len(terms), np.int64)
            lang_whole = np.int64(n_lang + smoothing * n_terms)
            in_lang[codes[:first]] = shares(n[:first], lang_whole, smoothing, scale)
            codes, source, n = codes[first:], source[first:], n[first:]
            share = shares(n, whole[source], smoothing, scale)
            absent = shares(np.zeros(len(names), np.int64), whole, smoothing, scale)
            above = share - in_lang[codes]
            starts = np.searchsorted(source, np.arange(len(names) + 1))
            sums = divergences(codes, source, share, absent, len(terms))
        else:
            sums = (np.zeros(len(names), np.int64) for _ in names)
        for s, (name, found) in enumerate(zip(names, sums)):
            add("pair", name, [*names[:s], *names[s + 1 :]], np.delete(found, s).tolist())
            if counts.num_rows:
                span = slice(starts[s], starts[s + 1])
                best = [(-v, terms[c]) for v, c in zip(above[span].tolist(), codes[span].tolist()) if v > 0]
                best = sorted(best, key=lambda x: (x[0], x[1].encode("utf-8", "surrogatepass")))[:most_terms]
                add("term", name, [term for _, term in best], [-v for v, _ in best])
        columns = [sum(column, []) for column in zip(*rows)] or [[]] * 5
        kinds = [pa.string()] * 4 + [pa.int64()]
        names = ["lang", "source", "part", "item", "value"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return evaluate


def distinct_texts(docs: DataFrame) -> DataFrame:
    """lang, text and copies: each text of a language once, with how often each source has it.

    The number of copies by source and the texts are brought down by map-side combining first, so
    a text that is a third of all rows leaves a task once. The texts cross the network once.
    """
    keyed = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = (
        keyed.groupBy("lang", "digest", "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "digest")
        .agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    )
    texts = keyed.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


def term_counts(docs: DataFrame, least_documents: int) -> DataFrame:
    """lang, shard, term, source, n of the kept terms; the row without source counts all sources.

    Tasks add up their texts per term and source, and send packed rows to shards of the terms, whose
    number grows with the bytes of text; a term leaves a task once, however frequent.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + size // SHARD_BYTES
    units = distinct_texts(docs).mapInArrow(counter(shards), UNIT)
    return units.groupBy("lang", "shard").applyInArrow(merger(least_documents), COUNT)


def audit(
    docs: DataFrame,
    least_documents: int = 30,
    smoothing: int = 5,
    scale: int = 10**9,
    most_terms: int = 50,
) -> DataFrame:
    """lang, source, part, item, value, rank: divergences of sources, and the terms that stand out.

    Terms are runs of letters and characters beyond ASCII, with A-Z in lower case. A language keeps
    the terms in at least ``least_documents`` of its documents. A group (lang, source), and the
    language as a whole, gives a kept term the share
    p = 1 + floor(scale * (n + smoothing) / (all n + smoothing * kept terms)).

    Part ``pair`` has a row for each other source of the language with the sum of abs(p - q) over
    all kept terms, 0 without any; part ``term`` the ``most_terms`` terms of the group with the
    largest p - q > 0 against the language. Ranks go by falling value, then by the item's bytes.

    Identical texts of a language are collapsed to one with its number of copies by source,
    tokenized once and counted as often as they stand. Counts go to shards of the terms; each shard
    evaluates its part of all pairs from the entries that are not zero. All arithmetic is exact.

    Null text, lang and source count as ''. Empty texts have no terms but are documents of their
    group. Repeated rows count each. A very long text is tokenized in slices. doc_id and other
    columns are ignored. An empty table gives no rows.
    """
    if scale % SPLIT:
        raise ValueError(f"scale must be a multiple of {SPLIT}")
    given = docs.select(
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")]
    )
    counts = written(term_counts(given, least_documents), "term-counts")
    of_lang = F.col("source").isNull()
    sources = counts.filter(~of_lang).groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    langs = (
        counts.filter(of_lang)
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("n_lang"))
    )
    heads = (
        given.select("lang", "source")
        .distinct()
        .join(sources, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["n_all", "n_terms", "n_lang"])
    )
    # Every shard of a language needs its groups; one without terms still has its pairs.
    used = counts.select("lang", "shard").unionByName(given.select("lang", F.lit(0).alias("shard"))).distinct()
    needed = heads.join(used, "lang").toDF(*heads.columns, "shard")
    found = (
        counts.groupBy("lang", "shard")
        .cogroup(needed.groupBy("lang", "shard"))
        .applyInArrow(evaluator(smoothing, scale, most_terms), FOUND)
        .groupBy("lang", "source", "part", "item")
        .agg(F.sum("value").alias("value"))
    )
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(best)).filter(
        (F.col("part") == "pair") | (F.col("rank") <= most_terms)
    )
