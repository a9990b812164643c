import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from conftest_paths import SMALL
from tokenizers import Tokenizer

from moodlake.llm import alignment
from moodlake.llm.queries import LEFT, QUERIES, RIGHT

PLACES = (public_tokenizers.path(LEFT), public_tokenizers.path(RIGHT), public_tokenizers.PATTERN)
TRICKY = [
    "plain words here", " leading", "trailing ", "two  spaces", "a\n b", "a \nb", "a\n \nb", "tab\tand\r\nline", "née Ünïcode 日本語 🙂 x",
    "▁ marks ▁", "<|endoftext|> and <s> </s> <unk> <0x41>", "a\x00b \x1c c", "nbsp here　wide", "don't we'll I'M",
    "x" * 3000, " ", "\n", "ﬁ Å \U0001fae8", "one", "end.\nNext line", "1234 5,678.90",
]


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(PLACES[0])
    left.encode_special_tokens = True
    stands = alignment.byte_of()
    spelled = {i: bytes(stands[c] for c in t) for t, i in left.get_vocab().items() if t != "<|endoftext|>"}
    return left, spelled, sentencepiece.SentencePieceProcessor(model_file=PLACES[1])


def brute(libraries, texts):
    """Per text: A ids, B ids, groups and linked pairs, token by token."""
    left, spelled, right = libraries
    out = []
    for text in texts:
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        bytes_a = [spelled[i] for i in a]
        bytes_b = [bytes([int(right.id_to_piece(i)[3:-1], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not (b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b)):
            out.append(([], [], "", []))
            continue
        spans = []
        for side in (bytes_a, bytes_b):
            at, found = 0, []
            for token in side:
                found.append((at, at + len(token)))
                at += len(token)
            spans.append(found)
        both = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        groups, held = [], ([], [])
        i = j = 0
        for end in sorted(both):
            group = ([], [])
            while i < len(a) and spans[0][i][1] <= end:
                group[0].append(str(a[i]))
                i += 1
            while j < len(b) and spans[1][j][1] <= end:
                group[1].append(str(b[j]))
                j += 1
            groups.append(",".join(group[0]) + "|" + ",".join(group[1]))
        at_byte = [[i for i, (s, e) in enumerate(side) for _ in range(s, e)] for side in spans]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(*at_byte)))]
        out.append((a, b, ";".join(groups), links))
    return out


def expected(libraries, rows):
    found = brute(libraries, [t for _, t in rows])
    counts = Counter(p for *_, links in found for p in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return sorted((
        i, len(a), len(b), groups.count(";") + 1 if groups else 0, len(links),
        hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
    ) for (i, _), (a, b, groups, links) in zip(rows, found))


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def rows_of(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def test_tricky_texts(spark, libraries):
    rows = list(enumerate(TRICKY * 2))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(alignment.link_counts(df, *PLACES, block=4)) == expected(libraries, rows)


def test_whole_table(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows_of(QUERIES["op13_tokenizer_alignment"](spark, SMALL)) == expected(libraries, rows)


def test_align_gives_ids_and_groups(spark, libraries):
    df = spark.createDataFrame(list(enumerate([*TRICKY, None, ""])), "a long, text string")
    for r in alignment.align(df, *PLACES).collect():
        a, b, groups, _ = brute(libraries, [r.row.text or ""])[0]
        assert (r.a, r.b) == (a, b)
        at_a = at_b = 0
        spelled = []
        for n, m in zip(r.group_a, r.group_b):
            spelled.append(",".join(map(str, r.a[at_a:at_a + n])) + "|" + ",".join(map(str, r.b[at_b:at_b + m])))
            at_a, at_b = at_a + n, at_b + m
        assert ";".join(spelled) == groups


def test_edges(spark, edge_docs, no_docs):
    out = alignment.link_counts(edge_docs, *PLACES).collect()
    assert len(out) == edge_docs.count()
    assert all((r.n_a, r.n_groups, r.n_links, r.groups_sha256, r.count_sum) == (0, 0, 0, "", 0) for r in out if r.doc_id in (0, 1))
    assert sum(r.doc_id == 4 for r in out) == 3 and sum(r.doc_id is None for r in out) == 1
    assert alignment.link_counts(no_docs, *PLACES).collect() == [] == alignment.align(no_docs, *PLACES).collect()
    clashing = edge_docs.withColumnsRenamed({"words": "row", "kept": "body", "fp": "group_a", "n": "id"})
    assert alignment.align(clashing, *PLACES).select("row.*").columns == clashing.columns


def test_terminals():
    import numpy as np
    assert alignment.terminals(np.array([1, 2, 3, 3, 5, 5])).tolist() == [3, 3, 3, 3, 5, 5]


def test_ids_out_of_merge_order_are_refused(folder):
    with open(PLACES[0], encoding="utf-8") as file:
        model = json.load(file)
    model["model"]["merges"] = model["model"]["merges"][1:] + model["model"]["merges"][:1]
    with open(f"{folder}/odd.json", "w", encoding="utf-8") as file:
        json.dump(model, file)
    with pytest.raises(ValueError, match="order of merges"):
        alignment.Pair(f"{folder}/odd.json", *PLACES[1:])
