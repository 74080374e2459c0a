import glob
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from driftwell.llm import queries, rans
from driftwell.session import scratch_path

BYTE_BPE = queries.tokenizer_path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 8192, 8193, 40_000, 70_001])
def test_section_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 4_000_000_000).astype(np.uint32)
    lengths = np.array([n // 3, 0, n - n // 3])
    frame = rans.encode_section(ids, [5, None, -7], lengths)
    ((file_no, body),) = rans.sections(b"FILE" + (9).to_bytes(8, "little") + frame + b"\n")
    got, doc_ids, held = rans.decode_section(body)
    assert file_no == 9 and doc_ids == [5, None, -7] and held.tolist() == lengths.tolist()
    assert np.array_equal(got, ids)
    checkpoints = -(-n // rans.CHECKPOINT)
    for c in range(checkpoints):  # each is decoded alone
        part, _, _ = rans.decode_section(body, np.array([c]))
        assert np.array_equal(part, ids[c * rans.CHECKPOINT : (c + 1) * rans.CHECKPOINT])


def test_coded_size_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.05, 1 << 18), 500).astype(np.uint32)
    p = np.bincount(ids) / len(ids)
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids)
    assert len(rans.encode_section(ids, [1], np.array([len(ids)]))) * 8 < bits * 1.06


def test_broken_sections_are_noticed():
    ids = np.arange(5000, dtype=np.uint32) % 50
    frame = b"FILE" + bytes(8) + rans.encode_section(ids, [1], np.array([5000]))
    for spot in (20, len(frame) - 40):
        broken = bytearray(frame)
        broken[spot] ^= 1
        with pytest.raises(ValueError):
            list(rans.sections(bytes(broken) + b"\n"))
    with pytest.raises(ValueError):
        list(rans.sections(frame[:-9] + b"\n"))
    # A wrong word that no frame checksum covers shows in its checkpoint.
    ((_, body),) = rans.sections(frame + b"\n")
    with pytest.raises(ValueError):
        rans.decode_section(body[:-6] + bytes([body[-6] ^ 255]) + body[-5:])


def test_frequencies_sum_up():
    for counts in ([1], [1, 10**12], list(range(1, 5000))):
        f = rans.frequencies(np.array(counts))
        assert f.sum() == 1 << rans.SCALE and f.min() >= 1


def test_files_round_trip(spark, awkward, rows, nothing, monkeypatch):
    monkeypatch.setattr(rans, "FILE_BYTES", 8 << 10)  # several files
    path = scratch_path(spark, "tokens")
    rans.write_tokens(awkward, path, BYTE_BPE, True, False, 0)
    assert len(glob.glob(f"{path}/part-*")) > 1
    lib = Tokenizer.from_file(BYTE_BPE)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = Counter(), 0
    for r in order:
        ids = np.array([*lib.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want[r[0], start, len(ids), zlib.crc32(ids.tobytes()), tuple(ids.tolist())] += 1
        start += len(ids)
    got = rans.read_tokens(spark, path).collect()
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], tuple(r["ids"])) for r in got) == want
    empty = scratch_path(spark, "tokens")
    rans.write_tokens(nothing, empty, BYTE_BPE, True, False, 0)
    assert rans.read_tokens(spark, empty).collect() == []
