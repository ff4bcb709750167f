"""Block hashes of files against hashlib over the same byte ranges."""

import hashlib
import random

from auditlens.sources import raw as R


def plain(data: bytes, size: int):
    """block -> hash: a line belongs to the block before where it begins at a range's first byte."""
    blocks, at = {}, 0
    if data.endswith(b"\n"):
        data = data[:-1]
    for line in data.split(b"\n") if data else []:
        blocks.setdefault(max(0, -(-at // size) - 1), []).append(line + b"\n")
        at += len(line) + 1
    return {k: (len(b"".join(v)), hashlib.sha256(b"".join(v)).hexdigest()) for k, v in blocks.items()}


def write(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)


def test_blocks_are_the_files_bytes(spark, tmp_path):
    rng = random.Random(1)
    lines = [bytes(rng.choices([9, 13, 32, 65, 124, 0xC3, 0xFF, 0], k=rng.randint(0, 90))) for _ in range(4000)]
    files = {"a.txt": b"\n".join(lines) + b"\n", "b.txt": b"x|y\r\n" * 900 + b"no line feed", "long.txt": b"z" * 9000 + b"\nshort\n" + b"w" * 5000, "one.txt": b"1"}
    for name, data in files.items():
        write(tmp_path / "in", name, data)
    got = {(r.file, r.block): (r.n_bytes, r.sha256) for r in R.block_hashes(spark, str(tmp_path / "in"), 4096).collect()}
    assert got == {(name, k): v for name, data in files.items() for k, v in plain(data, 4096).items()}
    assert sum(f == "a.txt" for f, _ in got) > 20


def test_changed_block_is_named(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "FAN", 4)
    line = b"%07d|aaaaaaaa\n"
    data = b"".join(line % i for i in range(5000))
    for folder, d in (("old", data), ("same", data), ("new", data.replace(b"0002500|a", b"0002500|b"))):
        write(tmp_path / folder, "f.txt", d)
        write(tmp_path / folder, "empty.txt", b"")
    at = {f: R.block_hashes(spark, str(tmp_path / f), 1000) for f in ("old", "new")}
    assert [tuple(r) for r in R.changed_blocks(at["old"], at["new"]).collect()] == [("f.txt", 2500 * 17 // 1000, "changed")]
    roots = {f: {r.file: (r.length, r.n_blocks, r.root) for r in R.file_fingerprints(spark, str(tmp_path / f), 1000).collect()} for f in ("old", "same", "new")}
    assert roots["old"] == roots["same"] and roots["old"]["f.txt"] != roots["new"]["f.txt"]
    assert roots["old"]["f.txt"][:2] == (85_000, 85) and set(roots["old"]) == {"f.txt"}


def test_a_missing_last_line_feed_changes_the_root(spark, tmp_path):
    write(tmp_path / "x", "f", b"a\nb\n")
    write(tmp_path / "y", "f", b"a\nb")
    assert len({R.file_fingerprints(spark, str(tmp_path / d)).first().root for d in "xy"}) == 2
