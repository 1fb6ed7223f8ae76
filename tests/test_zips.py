"""ZIP archives read by ranges of their directory, against the reader of the standard library."""

import io
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from lexspark.sources import archives, zips


def pack(members, method=zipfile.ZIP_DEFLATED, streaming=False):
    out = io.BytesIO()

    class Forward(io.RawIOBase):
        """No seeking back, so sizes stand behind the members."""

        def writable(self):
            return True

        def write(self, data):
            return out.write(data)

    with zipfile.ZipFile(Forward() if streaming else out, "w", method) as archive:
        for name, content in members:
            archive.writestr(name, content)
    return out.getvalue()


def expected(path, inner):
    rows = []
    with zipfile.ZipFile(path) as archive:
        for name in archive.namelist():
            if inner and name.endswith(".zip"):
                with zipfile.ZipFile(io.BytesIO(archive.read(name))) as own:
                    rows += [(f"{name}/{n}", own.read(n)) for n in own.namelist() if n.endswith(".xml")]
            elif not inner and name.endswith(".xml"):
                rows.append((name, archive.read(name)))
    return sorted(rows)


def found(spark, path, **options):
    rows = zips.read_members(spark, str(path), **options).collect()
    return sorted((r["member"], zips.unpacked(bytes(r["content"]), r["method"], r["crc"])) for r in rows)


def noise(seed, n):
    return random.Random(seed).randbytes(n)


def tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_members_by_range(spark, tmp_path):
    members = [(f"{k}_é.{'txt' if k % 7 == 3 else 'xml'}", noise(k, 500 + 40 * k)) for k in range(60)] + [("vuoto.xml", b"")]
    (tmp_path / "a.zip").write_bytes(pack(members))
    (tmp_path / "b.zip").write_bytes(b"prefix" * 9 + pack(members[:5], zipfile.ZIP_STORED))
    (tmp_path / "c.zip").write_bytes(pack([]))
    (tmp_path / "d.txt").write_bytes(b"no archive")
    want = expected(tmp_path / "a.zip", False) + expected(tmp_path / "b.zip", False)
    for split in (1, 4000, 1 << 30):
        assert found(spark, tmp_path, split=split) == sorted(want)
    read = zips.read_members(spark, str(tmp_path / "a.zip"), split=4000)
    assert 10 < tasks(read) <= read.rdd.getNumPartitions() < 60
    assert [r["member"] for r in zips.read_members(spark, str(tmp_path), first=True, split=1).collect()] == ["0_é.xml", "0_é.xml"]


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
@pytest.mark.parametrize("streaming", [False, True])
def test_one_huge_inner_archive_is_read_by_many_tasks(spark, tmp_path, method, streaming):
    """Stored, its own directory is planned; deflated, each task keeps every so-many-th member."""
    if streaming and method == zipfile.ZIP_STORED:
        inner = pack([(f"{k}.xml", noise(k, 3000)) for k in range(50)], streaming=True)
    else:
        inner = pack([(f"{k}.xml" if k % 5 else f"{k}.txt", noise(k, 3000) + b"a" * k) for k in range(50)], zipfile.ZIP_DEFLATED, streaming)
    (tmp_path / "uno.zip").write_bytes(pack([("x.zip", pack([("1.xml", b"<r/>")])), ("grande.zip", inner), ("leggimi.txt", b""), ("y.zip", pack([("2.xml", b"<r/>")]))], method))
    want = expected(tmp_path / "uno.zip", True)
    for split in (10_000, 40_000, 1 << 30):
        assert found(spark, tmp_path, inner=True, split=split) == want
    assert tasks(zips.read_members(spark, str(tmp_path), inner=True, split=10_000)) >= 10


def test_the_plan_alone_says_which_inner_archives_are_dealt_out(spark, tmp_path):
    """Inner archives between what the plan takes for many and the option's bytes are read once."""
    inner = [(f"{k}.zip", pack([(f"{j}.xml", noise(j, 200_000)) for j in range(8)])) for k in range(4)]
    (tmp_path / "a.zip").write_bytes(pack(inner))
    assert found(spark, tmp_path, inner=True, split=1 << 30) == expected(tmp_path / "a.zip", True)
    assert tasks(zips.read_members(spark, str(tmp_path), inner=True)) > 2


def test_archive_over_four_gigabytes(tmp_path):
    """Places of over 32 bits, in a file that is mostly a hole."""
    path, head = tmp_path / "grande.zip", zipfile.ZipFile
    with head(path, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("0.xml", b"<r/>")
        far = 5 << 30
        archive.fp.seek(far)
        archive.start_dir = far
        archive.writestr("1.xml", b"<s/>")
        for k in range(70_000):
            archive.filelist.append(archive.filelist[1])
    with open(path, "rb") as file:
        window = zips.Window(file, 0, path.stat().st_size)
        place = zips.directory(window)
        every = list(zips.entries(window, *place))
        assert len(every) == 70_002 and every[1][1].header == far
        assert [zips.unpacked(zips.packed(window, e), e.method, e.crc) for _, e in (*every[:2], every[-1])] == [b"<r/>", b"<s/>", b"<s/>"]
    reader = zips.MembersReader({"path": str(path), "split": "4000"})
    parts = reader.partitions()
    assert len(parts) > 50
    assert sum(b.num_rows for part in parts for b in reader.read(part)) == 70_002


def test_damage_is_an_error(spark, tmp_path):
    good = pack([("a.xml", b"<r>text</r>" * 50)])
    place = good.index(b"PK\1\2")
    (tmp_path / "a.zip").write_bytes(good[:place + 16] + struct.pack("<L", 7) + good[place + 20:])
    with pytest.raises(Exception, match="a damaged member"):
        archives.acts_by_range(spark, str(tmp_path)).collect()
    (tmp_path / "a.zip").write_bytes(b"not an archive")
    with pytest.raises(Exception, match="not a ZIP archive"):
        zips.read_members(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="FileNotFound|nowhere"):
        zips.read_members(spark, str(tmp_path / "nowhere")).collect()


def test_equals_the_reader_of_cells(spark, tmp_path):
    head = "<pronuncia><pronuncia_testata><anno_pronuncia>{}</anno_pronuncia></pronuncia_testata><massima><numero>{}</numero></massima></pronuncia>"
    files = [(f"{k}.xml", f"<r>{''.join(head.format(k, j) for j in range(5))}{'</r>' if k % 4 else ''}".encode()) for k in range(20)]
    for name, method in (("a.zip", zipfile.ZIP_STORED), ("b.zip", zipfile.ZIP_DEFLATED)):
        (tmp_path / name).write_bytes(pack([("x.zip", pack(files)), ("y.zip", pack(files[:3]))], method))
    (tmp_path / "c.zip").write_bytes(pack([("r.xml", b"<r><atto anno='1'/><atto anno='2'><numero_parte>3</numero_parte></atto></r>"), ("s.xml", b"<rotto>")]))
    cells = archives.read_archives(spark, str(tmp_path))
    plain = lambda df: sorted((r["archive"].split("/")[-1], r["member"], str(r["record"])) for r in df.collect())
    for split in (100, 1 << 20):
        assert plain(archives.rulings_by_range(spark, str(tmp_path), split=split)) == plain(archives.read_rulings(cells))
        assert plain(archives.acts_by_range(spark, str(tmp_path), "c.zip", split)) == plain(archives.read_acts(cells.where("archive LIKE '%c.zip'")))


def test_the_plan_opens_no_small_archive(tmp_path, monkeypatch):
    """Tasks read their directories, and hand on the members of many in one batch."""
    for k in range(300):
        (tmp_path / f"{k}.zip").write_bytes(pack([("x.zip", pack([(f"{j}.xml", noise(10 * k + j, 100)) for j in range(3)]))]))
    reader, real = zips.MembersReader({"path": str(tmp_path), "inner": "true", "tasks": "1"}), zips.directory
    monkeypatch.setattr(zips, "directory", lambda file: pytest.fail("opened by the plan"))
    parts = reader.partitions()
    monkeypatch.setattr(zips, "directory", real)
    batches = [b for part in parts for b in reader.read(part)]
    rows = sorted((r["archive"].split("/")[-1], r["member"], zips.unpacked(r["content"], r["method"], r["crc"])) for b in batches for r in b.to_pylist())
    assert rows == sorted((f"{k}.zip", *x) for k in range(300) for x in expected(tmp_path / f"{k}.zip", True))
    assert len(parts) == len(batches) == 1


def test_small_archives_are_dealt_by_their_bytes(tmp_path):
    for k in range(40):
        (tmp_path / f"{k}.zip").write_bytes(pack([("a.xml", noise(k, 1000))]))
    parts = zips.MembersReader({"path": str(tmp_path), "split": "6000"}).partitions()
    assert 5 < len(parts) < 15 and sum(len(p.whole) for p in parts) == 40
