"""Token counts, packing, license scans and media columns against brute force, with odd inputs."""

import hashlib
import math
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import license_scan, media_archive, pattern_packing, queries, token_counts
from tidemark.llm.common import table
from tidemark.llm.tokens import Ids, encode, library, pre_tokens


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_encoder_equals_the_library():
    import public_tokenizers
    import regex

    rng = random.Random(1)
    ascii_parts = [" ", "  ", "\n", "\t", "\r", "a", "B", "1", "'s", "'S", "'ll", "'", "!", "<|endoftext|>", "<|endoftext|", "\x1c", "\x1f", "\x0b", "\x00", "\x7f", "_", "thinking"]
    parts = [*ascii_parts, "é", "٣", "\u3000", "\x85", "\xa0", "漢", "😀"]
    texts = ["".join(rng.choices(p, k=rng.randint(0, 40))) for p in (parts, ascii_parts) for _ in range(3000)]
    texts += [f"a{chr(c)}1 {chr(c)}!" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts += [f"{chr(a)}{chr(b)}a" for a in range(128) for b in range(128)]
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text, e in zip(texts, library().encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(text).tolist() == e.ids
        assert pre_tokens()(text) == pattern.findall(text)
    few = Ids("byte_bpe_50k.json", 3)  # what isn't remembered is merged again
    assert [few[p] for p in ("a", " b", "c", " thinking", "a", " thinking")][3] == few[" thinking"] and len(few) == 3


def expected_tokens(text):
    return library().encode(text or "", add_special_tokens=False).ids


def test_token_counts(spark, odd_documents, no_documents, sf):
    for docs in (odd_documents, table(spark, sf, "documents")):
        for head in (token_counts.HEAD, 5):  # 5: nearly all pre-tokens go by the join
            got = Counter(tuple(r) for r in token_counts.count_tokens(docs, head=head).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())
            want = Counter((r["doc_id"], len((r["text"] or "").encode()), n := len(expected_tokens(r["text"])), n > 1024) for r in docs.collect())
            assert got == want
    assert token_counts.count_tokens(no_documents).count() == 0


def check_packing(rows, docs, capacity):
    pieces = by_id(rows)
    texts = Counter((r["doc_id"], r["text"]) for r in docs)
    n = 0
    for (key, text), times in texts.items():
        ids = np.array([*expected_tokens(text), 0], "<u4")
        bounds = pattern_packing.pieces_of(len(ids), capacity)
        assert len(ids) <= capacity or all(b - a == capacity for a, b in bounds[1:])
        for i, (a, b) in enumerate(bounds):
            same = [p for p in pieces[key] if (p["piece"], p["start"], p["length"], p["ids_crc32"]) == (i, a, b - a, zlib.crc32(ids[a:b].tobytes()))]
            assert len(same) == times
            n += times
    assert n == len(rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for content in sequences.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_round_trip(spark, odd_documents, no_documents, sf):
    for docs in (odd_documents, table(spark, sf, "documents")):
        for capacity in (2048, 100):
            rows = pattern_packing.pack(docs, capacity=capacity).collect()
            used = check_packing(rows, docs.collect(), capacity)
            assert used <= 1.03 * sum(r["length"] for r in rows) / capacity + 2
    assert pattern_packing.pack(no_documents).count() == 0


def best_fit(histogram):
    room, n = np.zeros(len(histogram), int), 0
    for length in range(len(histogram) - 1, 0, -1):
        for _ in range(histogram[length]):
            fits = np.flatnonzero(room[length:])
            if len(fits):
                r = fits[0] + length
                room[r] -= 1
                room[r - length] += 1
            else:
                n += 1
                room[len(histogram) - 1 - length] += 1
    return n


@pytest.mark.parametrize("kind", ["lognormal", "uniform", "middle", "one"])
def test_plan_against_best_fit(kind):
    rng = np.random.default_rng(3)
    draw = {"lognormal": lambda: rng.lognormal(6.5, 0.9, 3000).astype(int).clip(1, 2048), "uniform": lambda: rng.integers(1, 2049, 3000), "middle": lambda: rng.integers(700, 1500, 3000), "one": lambda: np.full(3000, 700)}[kind]()
    histogram = np.bincount(draw, minlength=2049)
    plan = pattern_packing.make_plan(histogram)
    assert plan.sequences <= 1.02 * best_fit(histogram) + 1
    at = pattern_packing.place(plan)
    lengths = np.repeat(np.arange(2049), histogram)
    ranks = np.concatenate([np.arange(c) for c in histogram])
    sequence, offset = at(lengths, ranks)
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], lengths[order]
    first = np.r_[True, s[1:] != s[:-1]]
    assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + n)[:-1][~first[1:]]).all() and (o + n <= 2048).all()
    assert len(set(s)) == plan.sequences


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute_base(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places}))


def test_license_scans(spark, odd_documents, no_documents, sf_more):
    for docs in (odd_documents, table(spark, sf_more, "documents")):
        texts = Counter((r["doc_id"], *brute_base(r["text"])) for r in docs.collect())
        rows = license_scan.scan_licenses(docs).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows) == texts
        for r in rows:
            assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
            assert 0 <= r["score"] <= 1 and (r["score"] == 1) >= bool(r["base_labels"])
    rows = by_id(license_scan.scan_licenses(odd_documents).collect())
    assert rows[13][0]["base_labels"] == "" and rows[13][0]["labels"] == "apache" and 0.8 < rows[13][0]["score"] < 1
    assert rows[12][0]["labels"] == "apache,gpl,mit" and {s["label"] for s in rows[12][0]["spans"]} >= {"apache", "mit"}
    assert rows[4][0]["labels"] == "" and rows[0][0]["score"] == 0
    assert license_scan.scan_licenses(no_documents).count() == 0


def brute_distance(a, b):
    """Least edits that turn a into some part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_fuzzy_search_finds_what_brute_force_finds():
    rng = random.Random(5)
    notices = {"released under the mit license": "mit", "licensed under cc by nc": "cc"}
    found = license_scan.matchers(notices, 3)
    for _ in range(150):
        notice = rng.choice(list(notices))
        chars = list(notice)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "q"])
        line = (" some words before " + "".join(chars) + " and after it ").encode()
        got = {s[0] for s in license_scan.fuzzy_spans(line, found, 3)}
        assert got == {label for n, label in notices.items() if brute_distance(n.encode(), line) <= 3}


def test_labels_of_the_table_by_plain_search(spark, sf):
    """Labels and scores against the regex library's own search of every notice in whole texts."""
    found = license_scan.matchers(license_scan.NOTICES, license_scan.EDITS)
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    several = 0
    for r in queries.op4_license_scans(spark, sf).collect():
        line = b" " + b" ".join(license_scan.words_of(docs[r["doc_id"]])) + b" "
        base = {label for phrase, label in license_scan.PHRASES.items() if b" " + phrase.encode() + b" " in line}
        labels, score = set(base), 1.0 if base else 0.0
        for notice, label, _, pattern in found:
            edits = [sum(m.fuzzy_counts) for m in pattern.finditer(line, overlapped=False)]
            if edits:
                labels.add(label)
                score = max(score, 1 - min(edits) / len(notice))
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(labels))
        assert r["score"] == pytest.approx(score)
        several += bool(labels)
    assert several


def padded(text):
    raw = (text or "").encode()
    return raw + b"\xff" * ((576 - len(raw) % 576) % 576 or (0 if raw else 576))


def test_media_round_trip(spark, odd_documents, no_documents, tmp_path):
    rows = media_archive.media_digests(odd_documents, folder=str(tmp_path / "a")).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["error"]) for r in rows)
    want = Counter((d["doc_id"], len((d["text"] or "").encode()), len(p := padded(d["text"])), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), None) for d in odd_documents.collect())
    assert got == want
    same = {}
    for r in rows:
        assert same.setdefault(r["payload_sha256"], (r["media_sha256"], r["media_bytes"], r["feature"])) == (r["media_sha256"], r["media_bytes"], r["feature"])
    assert media_archive.media_digests(no_documents, folder=str(tmp_path / "b")).count() == 0


def test_stored_form_and_features_by_brute_force(spark, sf, tmp_path):
    """Digests of the members as they lie in the archives, and features from the samples in plain Python."""
    folder = tmp_path / "f"
    docs = table(spark, sf, "documents")
    rows = {r["doc_id"]: r for r in media_archive.media_digests(docs, folder=str(folder)).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(rows) == set(texts)
    stored = {}
    for path in folder.glob("*.zip"):
        with zipfile.ZipFile(path) as z:
            for info in z.infolist():
                key, _ = media_archive.read_name(info.filename)
                stored[int(key)] = z.read(info)
    for key, text in texts.items():
        r, media, payload = rows[key], stored[key], padded(text)
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        mean = sum(payload) / len(payload)
        deviation = (sum((x - mean) ** 2 for x in payload) / len(payload)) ** 0.5
        entropy = -sum(n / len(payload) * math.log2(n / len(payload)) for n in Counter(payload).values())
        found = dict(x.split("=") for x in r["feature"].split(";"))
        assert abs(float(found["mean"]) - mean) < 1e-3 and abs(float(found["std"]) - deviation) < 1e-3 and abs(float(found["entropy"]) - entropy) < 1e-3
        assert len(found["ahash"]) == 16
    assert {media_archive.read_name(media_archive.member_name(3, k, 5)) for k in (None, "", "a_b/é_", "7")} == {(None, 5), ("", 5), ("a_b/é_", 5), ("7", 5)}


def test_archives_end_with_their_range(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    folder = str(tmp_path / "g")
    made = media_archive.write_archives(docs.coalesce(1), folder, archive_bytes=50_000).collect()
    assert len(made) > 3 and sum(r["members"] for r in made) == docs.count() and all(r["bytes"] <= 50_000 or r["members"] == 1 for r in made)
    rows = media_archive.describe_media(media_archive.read_archives(spark, folder)).collect()
    assert Counter(r["payload_sha256"] for r in rows) == Counter(hashlib.sha256(padded(d["text"])).hexdigest() for d in docs.collect())


def test_every_member_is_in_one_range(spark, odd_documents, tmp_path):
    folder = str(tmp_path / "c")
    media_archive.write_archives(odd_documents, folder).collect()
    rows = media_archive.read_archives(spark, folder, rangeBytes=700, batchBytes=1).collect()
    assert len(rows) == odd_documents.count() and len({(r["archive"], r["offset"]) for r in rows}) == len(rows)
    assert all(media_archive.from_png(r["media"]) for r in rows)


def test_a_damaged_member_is_reported_alone(spark, odd_documents, tmp_path):
    folder = tmp_path / "d"
    media_archive.write_archives(odd_documents.coalesce(1), str(folder)).collect()
    rows = media_archive.read_archives(spark, str(folder)).collect()
    bad = max(rows, key=lambda r: r["offset"])
    (path,) = folder.glob("*.zip")
    raw = bytearray(path.read_bytes())
    raw[bad["offset"] + 30 + len(bad["member"]) + 40] ^= 0xFF
    path.write_bytes(raw)
    again = media_archive.describe_media(media_archive.read_archives(spark, str(folder))).collect()
    assert len(again) == len(rows) and [r["payload_sha256"] is None for r in again].count(True) == 1
    assert sum(r["error"] is not None for r in again) == 1


def test_members_are_tried_again(monkeypatch, spark, odd_documents, tmp_path):
    folder = str(tmp_path / "e")
    media_archive.write_archives(odd_documents.coalesce(1), folder).collect()
    reader = media_archive.ArchiveReader({"path": folder})
    calls = Counter()
    read = media_archive.zipfile.ZipFile.read

    def fails_once(self, info, *a):
        calls[info.filename] += 1
        if calls[info.filename] == 1:
            raise OSError("lost")
        return read(self, info, *a)

    monkeypatch.setattr(media_archive.zipfile.ZipFile, "read", fails_once)
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in batches) == odd_documents.count() and all(e is None for b in batches for e in b.column("error").to_pylist())
    assert set(calls.values()) == {2}


def test_workers_forget_what_other_operators_kept():
    from tidemark.llm.common import forget, kept

    built = []
    build = lambda: built.append(1) or len(built)
    assert (kept("a test's model", build), kept("a test's model", build)) == (1, 1)
    forget()
    assert kept("a test's model", build) == 2
