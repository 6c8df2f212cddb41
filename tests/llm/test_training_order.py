from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import clashing, documents, rows

from daytally.llm import training_order as order
from daytally.llm.bpe import load


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 10, 97, 4096, 100_003])
def test_the_permutation_hits_every_slot_once(count):
    for key in (0, 1, 2**63):
        assert np.array_equal(np.sort(order.permuted(np.arange(count), count, key)), np.arange(count))


def test_another_key_gives_another_order():
    a, b = (order.permuted(np.arange(1000), 1000, key) for key in (1, 2))
    assert (a == b).mean() < 0.02
    assert np.array_equal(a, order.permuted(np.arange(1000), 1000, 1))


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    numbered = order.sequences(documents(spark), tokens=32)
    folder = str(tmp_path_factory.mktemp("shards") / "out")
    return numbered, order.write(numbered, folder, tokens=32, slots=100, waves=3)


def test_round_trip(spark, written):
    numbered, layout = written
    got = order.read(spark, layout).collect()
    assert sorted(r.slot for r in got) == list(range(layout.sequences))
    bpe, tokens = load(public_tokenizers.path(order.TOKENIZER)), defaultdict(list)
    stored = sorted((r.doc_id is None, r.doc_id, r.seq_no, bytes(r.tokens)) for r in numbered.collect() if r.doc_id is not None)
    assert stored == sorted((False, r.doc_id, r.seq_no, bytes(r.tokens)) for r in got if r.doc_id is not None)
    for r in got:
        assert len(r.tokens) == 2 * r.n_tokens
        tokens[r.doc_id].append((r.seq_no, np.frombuffer(bytes(r.tokens), np.uint16)))
    ids = [r[0] for r in rows()]
    for i, text, *_ in rows():
        if i is not None and ids.count(i) == 1:
            whole = np.concatenate([t for _, t in sorted(tokens[i], key=lambda x: x[0])])
            assert whole[-1] == 50256 and bpe.decode(whole[:-1].tolist()) == (text or "")


def test_the_index_names_what_the_files_hold(spark, written):
    numbered, layout = written
    named = order.index(numbered, layout).collect()
    assert all(layout.place(r.slot) == (r.shard, r.byte) for r in named)
    key = [(r.slot, r.doc_id, r.seq_no, r.n_tokens) for r in named]
    assert sorted(key) == sorted((r.slot, r.doc_id, r.seq_no, r.n_tokens) for r in order.read(spark, layout).collect())


def test_a_slot_is_found_by_arithmetic(spark, written, tmp_path):
    _, layout = written
    from pathlib import Path

    for slot in (0, 99, 100, layout.sequences - 1):
        shard, byte = layout.place(slot)
        data = next(Path(layout.folder, f"shard={shard}").glob("part-*")).read_bytes()
        assert np.frombuffer(data[byte:byte + 24], order._HEADER)["slot"][0] == slot
        assert data[byte + layout.stride - 1] == 0x0A
    part = order.read(spark, layout, 150, 420).collect()
    assert sorted(r.slot for r in part) == list(range(150, 420))


def test_missing_shards_are_written_again(spark, written):
    import shutil
    from pathlib import Path

    numbered, layout = written
    before = sorted((r.slot, bytes(r.tokens)) for r in order.read(spark, layout).collect())
    for shard in order.wave_of(layout, 3, 1):
        shutil.rmtree(Path(layout.folder, f"shard={shard}"))
    kept = {p: p.stat().st_mtime_ns for p in Path(layout.folder).rglob("part-*")}
    order.write(numbered, layout.folder, tokens=32, slots=100, waves=3)
    assert all(p.stat().st_mtime_ns == t for p, t in kept.items())
    assert sorted((r.slot, bytes(r.tokens)) for r in order.read(spark, layout).collect()) == before


def test_extra_columns_and_empty_tables(spark, tmp_path):
    layout = order.write(order.sequences(clashing(spark), tokens=32), str(tmp_path / "a"), tokens=32, slots=1000)
    assert order.read(spark, layout).count() == layout.sequences
    empty = order.write(order.sequences(documents(spark, [])), str(tmp_path / "b"))
    assert empty.shards == 0 and order.read(spark, empty).count() == 0
