import numpy as np
import pyarrow as pa
import pytest

from corpus_cases import BLANKS, frame, prose, sorted_rows
from remitscope.llm import substring_dedup


def expected(rows, window=20):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        words = BLANKS.findall(rows[i][1] or "")
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            own = tuple(words[at : at + window])
            if own in seen:
                gone[at : at + window] = [True] * window
            seen.add(own)
        kept = " ".join(word for word, no in zip(words, gone) if not no)
        out.append((rows[i][0], len(words), sum(gone), kept))
    return sorted_rows(out)


def found(docs, **options):
    columns = ["doc_id", "n_words", "n_removed", "text"]
    return sorted_rows(map(tuple, substring_dedup.without_repeats(docs, **options).select(columns).collect()))


@pytest.mark.parametrize("unit_bytes", [20_000, substring_dedup.UNIT_BYTES])
def test_awkward_rows(messy, messy_rows, unit_bytes):
    assert found(messy, unit_bytes=unit_bytes, shard_bytes=50_000) == expected(messy_rows)


def test_a_passage_in_every_document_and_overlapping_ones(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MOST_PHRASES", 5)
    shared, rows = prose(1, 70), []
    for i in range(120):
        cut = shared.split()[i % 30 : 25 + i % 45]
        rows.append((997 * i % 120, f"{prose(50 + i, 15)} {' '.join(cut)} {prose(90 + i % 7, 30)}"))
    rows += [(500, " ".join(["a b"] * 40)), (501, " ".join(["a"] * 60)), (502, " ".join(["b a"] * 12))]
    docs = frame(spark, rows).repartition(5)
    assert found(docs, unit_bytes=3000, shard_bytes=5000) == expected(rows)
    assert found(docs) == expected(rows)


def unit_of(texts, window=20):
    docs = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    return substring_dedup.Unit(docs, window)


@pytest.mark.parametrize("window", [8, 9, 16, 20, 31])
@pytest.mark.parametrize("most", [3, 100_000])
def test_automata_find_every_occurrence_word_for_word(window, most, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MOST_PHRASES", most)
    texts = [prose(1, 90, 10), prose(2, 60, 10), f"{prose(1, 90, 10)} x {prose(2, 60, 10)}", "a b " * 40, "a " * 50, "b a " * 30]
    unit = unit_of(texts, window)
    words = [w for text in texts for w in text.split()]
    own = [tuple(words[i : i + window]) for i in range(len(unit.valid))]
    first = {}
    for i in range(len(own)):
        if unit.valid[i]:
            first.setdefault(own[i], i)
    windows = np.array([i for n, i in enumerate(sorted(first.values())) if n % 3])
    known = {own[i]: n for n, i in enumerate(windows.tolist())}
    wanted = [known.get(own[i], -1) if unit.valid[i] else -1 for i in range(len(own))]
    assert substring_dedup.located(unit, windows).tolist() == wanted


def test_only_what_the_automata_find_is_removed(monkeypatch):
    unit = unit_of([prose(1, 50), prose(1, 50)])
    replies = {(kind, 0): np.zeros(31, bool) for kind in (substring_dedup.FIRSTS,)}
    replies[substring_dedup.ANCHORS, 0] = np.zeros(len(unit.values), bool)
    assert substring_dedup.repeats(unit, replies).sum() == 50

    class Finding(dict):
        def __init__(self, store):
            super().__init__()

        def add_word(self, word, value):
            self[word] = value

        def make_automaton(self):
            pass

        def iter(self, text):
            return iter(())

    monkeypatch.setattr(substring_dedup.ahocorasick, "Automaton", Finding)
    assert substring_dedup.repeats(unit, replies).sum() == 0


def test_other_columns_go_along(messy):
    out = substring_dedup.without_repeats(messy).select("doc_id", "rest.*")
    assert set(out.columns) == set(messy.columns) - {"text"}
    assert {row.unit for row in out.collect()} == {"unit of the input"}


def test_no_rows_and_short_windows(no_documents):
    assert substring_dedup.without_repeats(no_documents).count() == 0
    with pytest.raises(ValueError, match="at least"):
        substring_dedup.without_repeats(no_documents, window=3)
