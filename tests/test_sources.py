"""Archive and HTML sources on inline fixtures (bytes and markup built here)."""

import io
import struct
import zipfile

from pyspark.sql import functions as F

from mapfold.session import shared_dir
from mapfold.sources import archives, html, readers


def _shp(records):
    body = b""
    for i, (st, payload) in enumerate(records):
        content = struct.pack("<i", st) + payload
        body += struct.pack(">II", i + 1, len(content) // 2) + content
    header = struct.pack(">I", 9994) + b"\0" * 20 + struct.pack(">I", (100 + len(body)) // 2) + struct.pack("<ii", 1000, 0) + b"\0" * 64
    return header + body


def _poly(st, parts):
    pts = [p for part in parts for p in part]
    xs, ys = [p[0] for p in pts], [p[1] for p in pts]
    starts, k = [], 0
    for part in parts:
        starts.append(k)
        k += len(part)
    return (struct.pack("<4d", min(xs), min(ys), max(xs), max(ys)) + struct.pack("<2i", len(parts), len(pts))
            + struct.pack(f"<{len(parts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in pts))


def _dbf(rows, name="NAME", width=10):
    hdr = struct.pack("<BBBBIHH", 3, 0, 0, 0, len(rows), 32 + 32 + 1, 1 + width) + b"\0" * 20
    field = name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([width, 0]) + b"\0" * 14
    recs = b"".join(b" " + r.encode().ljust(width) for r in rows)
    return hdr + field + b"\x0d" + recs + b"\x1a"


def _archive():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("pt.shp", _shp([(1, struct.pack("<2d", 1.5, 2.5))]))
        z.writestr("pt.dbf", _dbf(["well"]))
        z.writestr("ln.shp", _shp([(3, _poly(3, [[(0, 0), (1, 1), (2, 0)]]))]))
        z.writestr("py.shp", _shp([(5, _poly(5, [[(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]]))]))
        z.writestr("py.prj", "GEOGCS[WGS84]")
    return buf.getvalue()


def test_zip_members_and_shapefiles(spark):
    d = shared_dir(spark, "test-zips")
    import os

    os.makedirs(d, exist_ok=True)
    with open(f"{d}/a.zip", "wb") as fh:
        fh.write(_archive())
    with open(f"{d}/bad.zip", "wb") as fh:
        fh.write(b"not a zip")
    m = archives.zip_members(spark, d).collect()
    assert sorted(r.ext for r in m if r.error is None) == [".dbf", ".prj", ".shp", ".shp", ".shp"]
    assert sum(r.error is not None for r in m) == 1
    f = archives.shapefiles(spark, d).where(F.col("error").isNull()).orderBy("layer").collect()
    kinds = {r.layer: (r.kind, len(r.parts[0])) for r in f}
    assert kinds == {"ln": ("LineString", 3), "pt": ("Point", 1), "py": ("Polygon", 5)}
    assert [r.attrs.get("NAME") for r in f if r.layer == "pt"] == ["well"]


def test_page_resources_and_metadata(spark):
    page = (
        '<ul><li class="resource-item"><h3> Admin boundaries </h3><a href="/dl/cod_ab.zip">get</a>'
        '<span class="update-date">Updated: March 2021</span></li>'
        '<li><h3>Notes</h3><a href="/about">about</a></li></ul>'
        "<table><tr><th>Source</th><td>National Office</td></tr>"
        "<tr><th>Time Period of the Dataset [?]</th><td>January 2015-December 2020</td></tr></table>"
    )
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    r = html.page_resources(pages).collect()
    assert [(x.title, x.href, x.file_name) for x in r] == [("Admin boundaries", "/dl/cod_ab.zip", "cod_ab_2021.zip")]
    meta = html.page_metadata(pages).first().meta
    assert meta["Source"] == "National Office"
    assert meta["Time Period of the Dataset [?]"] == "January 2015-December 2020"


def test_vertices_of_all_rings_and_parts_count(spark):
    ring = "[[0,0],[1,0],[1,1],[0,0]]"
    texts = [f"[{ring}]", f"[{ring}, {ring}]", f"[[{ring}],[{ring},{ring}]]", "[-1.5, 2]", "[[ 1e3,2 ],[-3,4]]", "[]", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string").select("i", readers.vertex_count("c").alias("n"))
    assert [r.n for r in df.orderBy("i").collect()] == [4, 8, 12, 1, 2, 0, None]
