"""Files in pieces: digests, encodings, lines and layouts are those of the whole file."""

import hashlib

import pytest

from marketrates.sources import files

TALL = 'version,hospital_name\n2.2.0,"H, ""x"""\ndescription,payer_name\na,b\n'
WIDE = "hospital_name,VERSION \r\nH, 3.0 \r\ndescription,standard_charge|P|Q|negotiated_dollar\r\n1,2\r\n"


@pytest.fixture
def folder(tmp_path):
    contents = {
        "utf": ("é–\n" * 400).encode(), "mark": b"\xef\xbb\xbf" + "é\r\nx".encode(), "west": "é–€\n".encode("cp1252") * 300, "late": b"a\n" * 500 + b"\xe9", "cut": b"ok\n\xe2\x82", "free": b"\x81\x8d\n",
        "tall": TALL.encode(), "wide": WIDE.encode("cp1252"), "json": b'\xef\xbb\xbf \n{"hospital_name": "x", "version": "3.0", ' + b" " * 5000 + b"}", "list": b"[1]", "long": b"version\n1\n" + b"x," * 3000,
    }
    for name, raw in contents.items():
        (tmp_path / f"{name}.dat").write_bytes(raw)
    (tmp_path / "none.dat").write_bytes(b"")  # Spark does not list it
    return tmp_path, contents


def name_of(path):
    return path.rsplit("/", 1)[1][:-4]


def plain(raw):
    try:
        return raw.decode("utf-8-sig"), "utf-8"
    except UnicodeDecodeError:
        return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in raw), "windows-1252"


@pytest.mark.parametrize("piece", [1, 3, 1 << 20])
def test_digests_and_lines(spark, folder, piece, monkeypatch):
    root, contents = folder
    monkeypatch.setattr(files, "_pieces", _small(piece))
    listed = files.listed(spark, str(root), "*.dat")
    got = {name_of(x["path"]): (x["byte_count"], x["length"], x["file_hash"], x["encoding"]) for x in files.digests(listed).collect()}
    assert got == {k: (len(v), len(v), hashlib.sha256(v).hexdigest(), plain(v)[1]) for k, v in contents.items()}
    lines = {}
    for x in files.decoded_lines(listed).orderBy("path", "line_ordinal").collect():
        lines.setdefault(name_of(x["path"]), []).append(x["line"])
    want = {k: [x.removesuffix("\r") for x in plain(v)[0].split("\n")] for k, v in contents.items()}
    assert lines == {k: v[:-1] if v[-1] == "" else v for k, v in want.items()}


def _small(size):
    from marketrates.sources.files import _open

    def pieces(path, _=0):
        with _open(path) as stream:
            while piece := stream.read(size):
                yield piece

    return pieces


def test_long_lines_come_in_parts(spark, tmp_path, monkeypatch):
    (tmp_path / "a").write_text("x" * 25 + "\nyy\n")
    monkeypatch.setattr(files, "_pieces", _small(4))
    monkeypatch.setattr(files, "LONGEST", 10)
    got = [tuple(x)[1:] for x in files.decoded_lines(files.listed(spark, str(tmp_path))).orderBy("line_ordinal", "part").collect()]
    assert "".join(x[2] for x in got if x[0] == 0) == "x" * 25 and max(len(x[2]) for x in got) <= 14 and got[-1][0::2] == (1, "yy")


def test_layouts(spark, folder, monkeypatch):
    root, _ = folder
    listed = files.listed(spark, str(root), "*.dat")
    got = {name_of(x["path"]): (x["layout"], x["version"]) for x in files.layouts(listed, 1000).collect()}
    assert got["tall"] == ("csv_tall", "2.2.0") and got["wide"] == ("csv_wide", "3.0") and got["json"] == ("json", "3.0") and got["list"] == ("json", None)
    assert got["utf"] == ("unknown", None) and got["long"] == ("unknown", "1")


def test_listing_opens_nothing(spark, folder):
    root, contents = folder
    plan = files.listed(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1] and files.listed(spark, str(root)).count() == len(contents)
