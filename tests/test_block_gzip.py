"""Block-compressed call files against the lines written and against a plain read of them."""

import gzip
import io
import random

import pytest

from somaloom.sources import block_gzip as B
from somaloom.sources import vcf


def blocks(text: bytes, draw, most: int) -> bytes:
    out, at = b"", 0
    while at < len(text):
        n = draw.randrange(most) + (draw.random() < 0.9)  # some empty members
        out += B._member(text[at:at + n])
        at += n
    return out + B.LAST


@pytest.mark.parametrize("seed", range(6))
def test_each_line_has_one_owner(seed):
    draw = random.Random(seed)
    texts = [bytes(draw.choices(b"ACGT\t\x1f\x8b", k=draw.choice([0, 1, 5, 40, 900]))) for _ in range(300)]
    whole = b"\n".join(texts) + (b"\n" if seed % 2 else b"x")
    want = whole.split(b"\n")[:-1] if seed % 2 else whole.split(b"\n")
    data = blocks(whole, draw, draw.choice([3, 60, 3000]))
    assert gzip.decompress(data) == whole
    for span in (1, 17, 30, 100, 1000, 5000, len(data)):
        if len(data) // span < 3000:
            got = [x for at in range(0, len(data), span) for x in B.lines(io.BytesIO(data), at, min(at + span, len(data)), len(data))]
            assert got == want, span


def test_payload_that_does_not_shrink():
    noise = random.Random(1).randbytes(B.PAYLOAD)
    assert gzip.decompress(B._member(noise)) == noise and B._length(B._member(noise)) == len(B._member(noise)) <= B.MEMBER


def test_other_files_are_an_error():
    for data in (gzip.compress(b"chr1\t5\n" * 99), b"chr1\t5\tplain\n" * 9):
        with pytest.raises(ValueError, match="not a block-compressed file"):
            list(B.lines(io.BytesIO(data), 0, len(data), len(data)))
    cut = B._member(b"a\nb\n") + B._member(b"c\n" * 500)[:-3]
    with pytest.raises(ValueError, match="damaged member"):
        list(B.lines(io.BytesIO(cut), 0, len(cut), len(cut)))


def test_block_files_equal_plain_ones(spark, tmp_path):
    draw = random.Random(3)
    records = [(f, i + 2, f"chr{draw.randrange(1, 4)}\t{draw.randrange(1, 9999)}\t.\tA\tT\t.\tPASS\tDP={i};X\tGT:DP\t0/1:{i}\t./.") for f in ("a", "b") for i in range(3000)]
    rows = [(f, 0, "##x") for f in "ab"] + [(f, 1, f"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{f}1\t{f}2") for f in "ab"] + records
    B.write_call_lines(spark.createDataFrame(rows, "file string, line_no int, value string"), str(tmp_path / "z"))
    for f in "ab":
        assert gzip.decompress((tmp_path / "z" / f"{f}.gz").read_bytes()).decode().split("\n")[:-1] == [v for g, _, v in sorted(rows) if g == f]
        (tmp_path / f"{f}.vcf").write_text("\n".join(v for g, _, v in sorted(rows) if g == f) + "\n")
    read = vcf.read_block_vcf(spark, str(tmp_path / "z"), span=4000)
    assert B.read_call_lines(spark, str(tmp_path / "z"), span=4000).rdd.getNumPartitions() > 4
    plain = vcf.read_vcf(spark, [str(tmp_path / "a.vcf"), str(tmp_path / "b.vcf")])
    key = lambda df: sorted(tuple(r) for r in vcf.vcf_fields(df, ["DP"], ["GT", "DP"]).drop("file").collect())
    assert key(read.fillna("")) == key(plain.fillna(""))
    region = vcf.read_block_vcf(spark, str(tmp_path / "z" / "a.gz"), chrom="chr2", start=100, end=5000)
    assert region.count() == 2 * sum(f == "a" and v.startswith("chr2\t") and 100 <= int(v.split("\t")[1]) <= 5000 for f, _, v in records) > 0
