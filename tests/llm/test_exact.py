"""Operators with one right answer, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from quayside.llm.bpe_chunks import ChunkEncoder, cut_chunks, encode_texts
from quayside.llm.components import components
from quayside.llm.fingerprints import edited_by_next, fingerprints
from quayside.llm.jaccard_join import near_groups, one_per_group, signatures, apart, shingle_sets
from quayside.llm.packing import cut, pack, plan
from quayside.llm.quality_rules import clean_lines, quality_rules
from quayside.llm.text import spans_hash, utf8, words
from quayside.llm.tokens import vocabulary_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sorted_rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


# ---- text helpers


def test_words_and_hashes_match_the_pattern(texts):
    import pyarrow as pa

    column = [t for _, t, _ in texts]
    data, offsets = utf8(pa.array(column))
    starts, ends, firsts = words(data, offsets)
    for row, text in enumerate(column):
        got = [data[a:b].tobytes().decode() for a, b in zip(starts[firsts[row]:firsts[row + 1]], ends[firsts[row]:firsts[row + 1]])]
        assert got == WORD.findall(text or "")
    keys = spans_hash(data, starts, ends)
    by_key = defaultdict(set)
    for k, a, b in zip(keys, starts, ends):
        by_key[k].add(data[a:b].tobytes())
    assert all(len(v) == 1 for v in by_key.values())
    assert len(by_key) == len({data[a:b].tobytes() for a, b in zip(starts, ends)})


# ---- 1


def brute_rules(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_rules_count_as_brute_force(docs, texts):
    got = sorted_rows(quality_rules(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted([(i, *brute_rules(t)) for i, t, _ in texts], key=repr)


def test_rules_keep_prose_and_reject_junk(docs):
    kept = dict(quality_rules(docs).filter("doc_id is not null").select("doc_id", "kept").collect())
    assert all(kept[k] for k in range(90) if k % 11 > 2)
    assert not any(kept[120 + k] for k in range(40))
    assert not kept[200] and not kept[214]


def test_boilerplate_is_judged_by_its_share(spark):
    prose = "The people of the house read more of the water than others, and they wrote about it in the morning. "
    cookies = ["We use cookies on this site.", "Read our privacy policy and our cookie policy.", "Terms of use apply here."]
    rows = [
        (1, prose * 20),                                                       # a long line with a phrase is prose
        (2, "\n".join(cookies * 6 + [prose])),                                 # most of the text is boilerplate
        (3, prose[:60] + "house by the water.\nThis work is licensed under the GNU General Public License, version 3.\n"),
        (4, "Copyright © the people of the house and the water.\n" + prose.replace("read more", "knew more") * 3),
        (5, "All rights reserved.\n \n"), (6, cookies[0] + "\n" + prose),
    ]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    def chars(text):
        return sum(map(len, WORD.findall(text)))

    assert got[1].prose_chars == chars(rows[0][1]) and got[1].lost_chars == 0
    assert not got[2].kept and got[2].lost_chars == chars("".join(cookies * 6)) and got[2].prose_chars == chars(prose)
    assert got[3].kept and got[3].lost_chars == 0 and got[3].prose_chars == chars(rows[2][1].split("\n")[0])
    assert got[4].lost_chars == chars(rows[3][1].split("\n")[0])
    assert not got[5].kept and got[5].prose_chars == 0 and got[5].lost_chars == 0
    assert got[6].lost_chars == chars(cookies[0]) and got[6].kept


def test_clean_lines(spark):
    df = spark.createDataFrame([("A good line.\nhome | about | contact | help\nAll rights reserved.\nBUY!! NOW!! YES!!",)], "t string")
    assert df.select(clean_lines(df.t)).first()[0] == "A good line."


# ---- 3


def brute_groups(texts):
    sets = []
    for _, text, _ in texts:
        w = WORD.findall(lower(text or ""))
        sets.append({tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set())
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 90 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    small = {}
    for k, (i, _, _) in enumerate(texts):
        r = find(k)
        if i is not None:
            small[r] = min(small.get(r, i), i)
    return sorted([(i, len(sets[k]), small.get(find(k))) for k, (i, _, _) in enumerate(texts)], key=repr)


def test_groups_match_brute_force(docs, texts):
    assert sorted_rows(near_groups(docs), "doc_id", "n_shingles", "component_id") == brute_groups(texts)


def test_many_near_copies_and_tiles(spark, monkeypatch):
    import quayside.llm.jaccard_join as J

    monkeypatch.setattr(J, "TILE", 8)
    base = [f"word{k}" for k in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        for j in range(k % 5):
            w[(k * 13 + j * 29) % 120] = f"other{k}n{j}"
        rows.append((k, " ".join(w), "en"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted_rows(near_groups(df), "doc_id", "n_shingles", "component_id") == brute_groups(rows)


def test_one_row_per_group_keeps_columns(docs, texts):
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute_groups(texts) if c is not None}
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert Counter(i for i in ids if i is not None) == Counter(want)
    assert ids.count(None) == 2


def brute_wide_groups(texts, width, percent):
    """Ids, set sizes and smallest ids reachable, for shingles of ``width`` words."""
    words_of = [WORD.findall(lower(t or "")) for _, t, _ in texts]
    sets = [{tuple(w[i:i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set() for w in words_of]
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    small = {}
    for g, (i, _, _) in zip(group, texts):
        if i is not None:
            small[g] = min(small.get(g, i), i)
    return sorted([(i, len(s), small.get(g)) for g, s, (i, _, _) in zip(group, sets, texts)], key=repr)


def test_five_word_groups_match_brute_force(spark, docs, texts):
    got = sorted_rows(near_groups(docs, width=5, percent=80), "doc_id", "n_shingles", "component_id")
    assert got == brute_wide_groups(texts, 5, 80)


def test_pipeline_links_a_replaced_passage(spark):
    from corpus_pipeline import near_copies

    rows = []
    for k in range(8):  # from 4 on with a passage of a tenth of the words replaced
        w = [f"t{k % 4}w{j}" for j in range(500)]
        w[40:90] = w[40:90] if k < 4 else [f"new{k}w{j}" for j in range(50)]
        rows.append((k, " ".join(w), "en"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len({c for _, _, c in brute_groups(rows)}) == 8
    want = {c for _, _, c in brute_wide_groups(rows, 5, 80)}
    assert want == {0, 1, 2, 3} == {r[0] for r in near_copies(spark, df, "").select("doc_id").collect()}


def test_rows_without_an_id_link_others(spark):
    base = [f"w{k}" for k in range(200)]

    def changed(n):
        return " ".join(base[:50] + [f"n{j}" for j in range(n)] + base[50 + n:])

    rows = [(1, changed(0), "en"), (None, changed(6), "en"), (2, changed(12), "en"), (None, "quite another text", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = brute_groups(rows)
    assert {c for _, _, c in want} == {1, None}  # 1 and 2 meet by way of the row without an id
    assert {c for _, _, c in brute_groups([rows[0], rows[2]])} == {1, 2}
    assert sorted_rows(near_groups(df), "doc_id", "n_shingles", "component_id") == want


def test_signatures_never_exceed_the_difference():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    sizes = [3, 200, 1023, 1025, 1100, 5000, 5200]
    pool = rng.integers(0, 2**63, 6000).astype(np.uint64)
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in sizes]
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    data, offsets = signatures(np.concatenate(sets), firsts)
    column = pa.array([data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary())
    i, j = np.array([2, 3, 5, 0]), np.array([3, 4, 6, 0])
    far = apart(column, np.array(sizes), i, j)
    for a, b, d in zip(i, j, far):
        assert d <= len(set(sets[a]) ^ set(sets[b]))
    assert far[3] == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, 100 + k) for k in range(1, 9)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(21)}, **{100 + k: 100 for k in range(9)}}


# ---- 4


@pytest.fixture(scope="session")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_equal_the_library(docs, texts, library):
    got = sorted_rows(encode_texts(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")
    want = []
    for i, text, _ in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest(), ids))
    assert got == sorted(want, key=repr)


def test_any_cuts_are_repaired(library):
    coder = ChunkEncoder(vocabulary_path())
    rng = np.random.default_rng(2)
    samples = ["don't you'll we're I'd 'tis  two  spaces\n\n lines\t tab <|endoftext|> end", "é è 日本 𝄞 x" * 9,
               "a b c d e f 12 345 6.7 -- !! ?? ''re 'r e 'l l", " lead and trail ", "\n\n\nx\n\n y    z"]
    for text in samples:
        want = library.encode(text, add_special_tokens=False).ids
        for _ in range(60):
            cuts = sorted(set(rng.integers(1, len(text), int(rng.integers(1, 12))).tolist()))
            parts = [text[a:b].encode() for a, b in zip([0, *cuts], [*cuts, len(text)])]
            assert coder.encode(parts).tolist() == want


def test_shared_chunks_are_encoded_once():
    import pyarrow as pa

    passage = " ".join(f"token{k} of a passage" for k in range(900))
    data, offsets = utf8(pa.array(["One start. " + passage, "Another, longer start. " + passage]))
    starts, firsts = cut_chunks(data, offsets)
    coder, raw = ChunkEncoder(vocabulary_path()), data.tobytes()
    for row in range(2):
        edges = [*starts[firsts[row]:firsts[row + 1]].tolist(), int(offsets[row + 1])]
        coder.encode([raw[a:b] for a, b in zip(edges, edges[1:])])
    assert coder.reused > coder.encoded / 2


# ---- 5


def chunk_lengths(text):
    """Chunks of a fingerprint with their lengths, the last four hex digits of each."""
    return {text[k:k + 16]: int(text[k + 12:k + 16], 16) for k in range(0, len(text), 16)}


def containment(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[k] for k in a.keys() & b.keys()) / min(sum(a.values()), sum(b.values()))


def test_rows_without_ids_are_dealt_and_stay_in_order(spark, docs):
    rows = [(None, f"text number {k} of many " * 8) for k in range(300)] + [(5, "one with an id " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = edited_by_next(df).collect()
    assert len(got) == 301
    hashes = {r["text"]: r["tie"] for r in df.selectExpr("text", "xxhash64(text) tie").collect()}
    order = [rows[-1][1]] + sorted((t for i, t in rows if i is None), key=lambda t: -hashes[t])
    want = Counter()
    for k, text in enumerate(order):
        n = len(text) // 3
        want[hashlib.sha256((text[:len(text) - n] + order[(k + 1) % len(order)][:n]).encode()).hexdigest()] += 1
    assert Counter(r["edited_sha256"] for r in got) == want


def test_edited_texts_and_fingerprints(docs, texts, spark):
    rows = [r for r in texts if r[0] is not None and r[0] != 3 and r[0] % 2 == 0]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in edited_by_next(df).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for k, (i, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        edited = text[:len(text) - n] + after[:n]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["n_chars"] == len(text)
        if edited == text:
            assert got[i]["near_edited"] == 1 and got[i]["fingerprint"] == got[i]["edited_fingerprint"]
        own, other, next_ = (chunk_lengths(x) for x in (
            got[i]["fingerprint"], got[i]["edited_fingerprint"], got[order[(k + 1) % len(order)][0]]["fingerprint"]))
        assert got[i]["near_edited"] == pytest.approx(containment(own, other))
        assert got[i]["near_next"] == pytest.approx(containment(own, next_))
    whole = {r["doc_id"]: r for r in fingerprints(docs).collect()}
    assert all(whole[i]["fingerprint"] == got[i]["fingerprint"] for i in got)
    assert whole[100]["fingerprint"] == whole[0]["fingerprint"] != whole[1]["fingerprint"]


def test_odd_ids_in_editing(docs, texts, nothing):
    assert edited_by_next(docs).count() == len(texts)
    one = edited_by_next(docs.filter("doc_id = 5")).first()
    assert one["near_next"] == 1
    assert edited_by_next(nothing).count() == 0


def test_insertion_shifts_few_chunks(spark):
    text = " ".join(f"sentence number {k * 7919 % 1000} stands here" for k in range(400))
    a, b, c = (r["fingerprint"] for r in fingerprints(spark.createDataFrame(
        [(1, text), (2, "New words first. " + text), (3, text[::-1])], "doc_id long, text string").coalesce(1)).orderBy("doc_id").collect())
    chunks = [{x[k:k + 16] for k in range(0, len(x), 16)} for x in (a, b, c)]
    assert len(chunks[0] & chunks[1]) > 0.9 * len(chunks[0]) and not chunks[0] & chunks[2]


# ---- 9


def first_fit(lengths, size):
    """First-fit decreasing, document by document."""
    room = []
    for n in sorted(lengths, reverse=True):
        k = next((k for k, r in enumerate(room) if r >= n), None)
        if k is None:
            room.append(size - n)
        else:
            room[k] -= n
    return len(room)


def test_pieces_are_whole_gapless_and_few(docs, texts, library):
    got = [r.asDict() for r in pack(docs, size=256).collect()]
    want = Counter()
    for i, text, _ in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for number, (start, length) in enumerate(cut(len(ids), 256)):
            crc = zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
            want[i, number, start, length, crc] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for content in bins.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= 256
    assert len(bins) <= first_fit([r["length"] for r in got], 256)


@pytest.mark.parametrize("lengths", [[], [256], [1] * 1000, [129] * 7 + [127] * 7, [200, 100, 90, 60, 56, 55, 1, 1]])
def test_plans_use_every_document_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=257)
    by_length = defaultdict(list)
    for length, first, times, sequence, offset in plan(counts, 256):
        assert times > 0 and 0 <= offset < 256
        by_length[length].append((first, times, sequence, offset))
    placed = defaultdict(list)
    for length, rows in by_length.items():
        rows.sort()
        assert rows[0][0] == 0
        for (first, times, sequence, offset), stop in zip(rows, [*(r[0] for r in rows[1:]), int(counts[length])]):
            assert (stop - first) % times == 0  # as many documents in each of the sequences
            for r in range(first, stop):
                placed[sequence + (r - first) % times].append((offset + (r - first) // times * length, length))
    assert Counter(n for spans in placed.values() for _, n in spans) == Counter(lengths)
    for spans in placed.values():  # gapless from 0, and never over the size
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 256
    if lengths:
        assert len(placed) <= 1.25 * math.ceil(sum(lengths) / 256) + 1
    assert cut(600, 256) == [(0, 88), (88, 256), (344, 256)] and cut(256, 256) == [(0, 256)]


def test_empty_tables(nothing):
    for df in (quality_rules(nothing), near_groups(nothing), encode_texts(nothing), fingerprints(nothing), pack(nothing), one_per_group(nothing)):
        assert df.count() == 0


def test_shingles_shorter_than_the_width():
    import pyarrow as pa

    data, offsets = utf8(pa.array(["a b", "A B", "a", "", None, "b a"]))
    values, firsts = shingle_sets(data, offsets, 3)
    assert np.diff(firsts).tolist() == [1, 1, 1, 0, 0, 1]
    assert values[0] == values[1] != values[3]


def test_pairs_that_are_no_partners_are_rarely_written(spark, monkeypatch):
    """Texts that share most shingles and are not linked meet in many index entries."""
    import quayside.llm.jaccard_join as J

    base = [f"word{k}" for k in range(600)]
    rows = []
    for k in range(24):
        w = list(base)
        for j in range(20):
            w[(j * 30 + k) % 600] = f"own{k}n{j}"
        rows.append((k, " ".join(w), "en"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    written, pairs = [], J._pairs

    def counted(*args):
        found = pairs(*args)
        written.append(found.count())
        return found

    monkeypatch.setattr(J, "_pairs", counted)
    assert sorted_rows(near_groups(df, width=5, percent=80), "doc_id", "n_shingles", "component_id") == brute_wide_groups(rows, 5, 80)
    assert written[1] <= 24 * 23 / 2, written
