import itertools
import random
import re

import duckdb
import pytest

from corpus_cases import LOWER, frame, sorted_rows
from remitscope.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(rows):
    out = []
    for doc_id, text in rows:
        words = WORDS.findall((text or "").translate(LOWER))
        starts, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            own = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
            starts += at
            labels |= {label} if at else set()
        ends = (min(starts), max(starts)) if starts else (None, None)
        out.append((doc_id, len(words), len(starts), *ends, ",".join(sorted(labels))))
    return sorted_rows(out)


COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]


def test_awkward_rows(messy, messy_rows):
    found = licenses.license_scan(messy).select(COLUMNS).collect()
    assert sorted_rows(map(tuple, found)) == base(messy_rows)


def test_overlapping_phrases_and_partial_starts(spark):
    texts = [
        "cc by cc by-cc by",
        "cc cc by all all rights rights reserved all rights reserved",
        "general general public license general public public license",
        "ccé by ccby CC\x7fBY CK by",
        "all rights all rights reserved cc general public license",
    ]
    rows = list(enumerate(texts))
    found = licenses.license_scan(frame(spark, rows)).select(COLUMNS).collect()
    assert sorted_rows(map(tuple, found)) == base(rows)


def test_matching_statistics_equal_plain_search():
    automaton = licenses.Automaton({"a b": "x"}, [("y", "a b c a b d"), ("z", "c a b c")])
    words = "a b c a b c a b d q a b d c a".split()
    texts = [["a", "b"], "a b c a b d".split(), "c a b c".split()]
    _, matches = automaton.scan([w.encode() for w in words])
    wanted = set()
    for start in range(len(words)):
        for end in range(start + licenses.LEAST_MATCH, len(words) + 1):
            own = words[start:end]
            inside = [
                (t, i + len(own)) for t, text in enumerate(texts) for i in range(len(text)) if text[i : i + len(own)] == own
            ]
            longer = end < len(words) and any(
                text[i : i + len(own) + 1] == words[start : end + 1] for text in texts for i in range(len(text))
            )
            left = start and any(text[i : i + len(own) + 1] == words[start - 1 : end] for text in texts for i in range(len(text)))
            if not longer and not left:
                wanted |= {(start, end, t, upto) for t, upto in inside}
    assert {tuple(m) for m in matches} == wanted


def test_phrases_of_one_word_are_found_alone():
    automaton = licenses.Automaton({"gpl": "gpl", "cc by": "cc-by"}, [("y", "a b c")])
    places, _ = automaton.scan([b"under", b"gpl", b"or", b"cc", b"by", b"and", b"gpl"])
    assert places == [(1, 0), (3, 1), (6, 0)]


def test_whole_and_damaged_notices_are_spans(spark):
    label, notice = next((label, text) for label, text in licenses.TEMPLATES if len(text.split()) > 60)
    words = notice.split()
    damaged = " ".join([*words[:30], "noise", *words[32:]])
    rows = [(0, f"Before this. {notice} After it."), (1, damaged), (2, " ".join(words[:10])), (3, " ".join(reversed(words)))]
    found = {row.doc_id: row for row in licenses.license_scan(frame(spark, rows)).collect()}
    assert found[0].score == 1 and label in found[0].labels.split(",")
    assert 0.8 < found[1].score < 1 and label in found[1].labels.split(",")
    assert label not in found[3].labels.split(",")
    span = max(found[0].spans, key=lambda s: s.end - s.start)
    assert span.start >= 2 and span.cover == 1


def test_no_rows(no_documents):
    assert licenses.license_scan(no_documents).count() == 0


def labels_of(text):
    automaton = licenses.Automaton(licenses.PHRASES, licenses.TEMPLATES)
    row = licenses.examine(0, text, automaton)
    return set(filter(None, row["labels"].split(","))), row["score"]


@pytest.mark.parametrize("label", ["mit", "apache-2.0", "bsd"])
@pytest.mark.parametrize("noise", [9, 25])
def test_notices_with_words_in_the_middle_keep_their_label(label, noise):
    notice = max((text for own, text in licenses.TEMPLATES if own == label), key=len).split()
    middle = len(notice) // 2
    foreign = [f"foreign{i}" for i in range(noise)]
    found, score = labels_of(" ".join([*notice[:middle], *foreign, *notice[middle:]]))
    assert found == {label} and score > 0.9


def test_a_notice_edited_around_each_repeated_phrase_keeps_its_label():
    notice = next(text for label, text in licenses.TEMPLATES if label == "bsd")
    edited = notice.replace("the above copyright notice", "XX the above copyright notice").replace("disclaimer", "disclaimer YY")
    assert labels_of(edited)[0] == {"bsd"}


def test_no_version_from_a_mention_without_one():
    assert labels_of("licensed under the GNU General Public License")[0] == {"gpl"}
    assert labels_of("licensed under the GNU General Public License, version 4")[0] == {"gpl"}
    assert labels_of("licensed under the GNU General Public License, version 3")[0] == {"gpl", "gpl-3.0"}
    assert labels_of("licensed under the GNU General Public License, version 2 only")[0] == {"gpl", "gpl-2.0"}


def test_more_evidence_never_scores_less():
    assert labels_of("cc by")[1] == labels_of("under CC BY 4.0")[1] == labels_of("Licensed under CC BY 4.0")[1] == 1
    assert labels_of("nothing of the kind")[1] == 0


def test_two_copies_of_a_notice_are_two_spans():
    notice = next(text for label, text in licenses.TEMPLATES if label == "bsd")
    automaton = licenses.Automaton(licenses.PHRASES, licenses.TEMPLATES)
    spans = licenses.examine(0, f"{notice} and then {notice}", automaton)["spans"]
    assert [span["label"] for span in spans] == ["bsd", "bsd"] and spans[0]["end"] < spans[1]["start"]


def test_the_best_chain_is_the_best_of_all(monkeypatch):
    draw = random.Random(5)
    for _ in range(300):
        matches = []
        for _ in range(draw.randrange(1, 8)):
            size, end = draw.randrange(1, 5), draw.randrange(5, 30)
            matches.append(licenses.Match(end - size, end, 0, draw.randrange(size, 20)))
        matches.sort(key=lambda m: (m.end, m.start, m.upto))
        reach = draw.randrange(0, 12)
        best = 0
        for n in range(1, len(matches) + 1):
            for chain in itertools.combinations(matches, n):
                covered = chain[0].end - chain[0].start
                for a, b in zip(chain, chain[1:]):
                    more = licenses.added(a, b)
                    if more <= 0 or a.end >= b.end or a.upto >= b.upto or b.start - a.end > reach:
                        break
                    covered += more
                else:
                    best = max(best, covered)
        assert licenses.chains_of(matches, reach, 1)[0].covered == best


def test_many_copies_of_a_notice_take_time_in_proportion():
    notice = next(text for label, text in licenses.TEMPLATES if label == "bsd")
    automaton = licenses.Automaton(licenses.PHRASES, licenses.TEMPLATES)
    row = licenses.examine(0, " ".join([notice] * 2000), automaton)
    assert len(row["spans"]) == 2000 and {s["label"] for s in row["spans"]} == {"bsd"}


BASE_SQL = r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), places AS (
        SELECT doc_id, i - 1 AS place, CASE
            WHEN w[i] = 'cc' AND w[i + 1] = 'by' THEN 'cc-by'
            WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl'
            WHEN w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved' THEN 'reserved' END AS label
        FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
    )
    SELECT doc_id, len(any_value(w)) AS n_words, count(label) AS n_base,
           min(place) FILTER (label IS NOT NULL) AS first_word, max(place) FILTER (label IS NOT NULL) AS last_word,
           coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
    FROM words LEFT JOIN places USING (doc_id) GROUP BY doc_id
"""


def test_base_columns_equal_sql(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    wanted = sorted_rows(duck.execute(BASE_SQL.replace("\\\\", "\\")).fetchall())
    found = licenses.license_scan(spark.read.parquet(path)).select(COLUMNS).collect()
    assert sorted_rows(map(tuple, found)) == wanted
