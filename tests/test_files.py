import gzip
import json
import math
import zipfile

import pytest
from pyspark.sql import functions as F

from gevel import sinks
from gevel import sources as SO
from gevel.functions import geometry as G
from gevel.operators import documents as D
from gevel.operators import history as H
from gevel.plans import reconstruction
from gevel.session import cut_lineage, shared_dir
from gevel.sources import files as FI
from gevel.sources import register as RG

PAND = """<?xml version="1.0"?><x:stand xmlns:x="s" xmlns:Objecten="o" xmlns:Historie="h" xmlns:gml="g">{}</x:stand>"""
OBJECT = """<x:bagObject><Objecten:Pand><Objecten:identificatie domein="NL.IMBAG.Pand">{id}</Objecten:identificatie>
<Objecten:geometrie>{geom}</Objecten:geometrie><Objecten:oorspronkelijkBouwjaar>1907</Objecten:oorspronkelijkBouwjaar>
<Objecten:status>Pand in gebruik</Objecten:status><Objecten:geconstateerd>N</Objecten:geconstateerd><Objecten:documentdatum>2010-01-02</Objecten:documentdatum>
<Objecten:voorkomen><Historie:Voorkomen><Historie:voorkomenidentificatie>1</Historie:voorkomenidentificatie>
<Historie:beginGeldigheid>2010-01-02</Historie:beginGeldigheid></Historie:Voorkomen></Objecten:voorkomen></Objecten:Pand></x:bagObject>"""
RING = "<gml:LinearRing><gml:posList>{}</gml:posList></gml:LinearRing>"


def polygon(outer, *inner):
    holes = "".join(f"<gml:interior>{RING.format(i)}</gml:interior>" for i in inner)
    return f"<gml:Polygon><gml:exterior>{RING.format(outer)}</gml:exterior>{holes}</gml:Polygon>"


def test_register_files_with_bbox(spark, tmp_path):
    a = polygon("0 0 9 4 0 9 4 4 9 0 4 9 0 0 9", "1 1 9 1 2 9 2 2 9 1 1 9")
    two = "".join(f"<gml:surfaceMember>{polygon(p)}</gml:surfaceMember>" for p in ("50 50 0 51 50 0 51 51 0 50 50 0", "60 60 0 62 60 0 62 62 0 60 60 0"))
    (tmp_path / "1.xml").write_text(PAND.format(OBJECT.format(id="0001", geom=a)))
    (tmp_path / "2.xml").write_text(PAND.format(OBJECT.format(id="0002", geom=f"<gml:MultiSurface>{two}</gml:MultiSurface>")))
    rows = {r.identificatie: r for r in SO.read_register_xml(spark, str(tmp_path), "pand").withColumn("a", F.transform("geometry", G.area)).collect()}
    assert rows["NL.IMBAG.Pand.0001"].a == [15.5] and rows["NL.IMBAG.Pand.0002"].a == [0.5, 2.0]
    assert rows["NL.IMBAG.Pand.0001"].oorspronkelijkbouwjaar == 1907 and rows["NL.IMBAG.Pand.0001"].geconstateerd is False
    near = SO.read_register_xml(spark, str(tmp_path), "pand", bbox=(61, 61, 70, 70))
    assert [r.identificatie for r in near.collect()] == ["NL.IMBAG.Pand.0002"]


def test_register_layers_to_snapshot(spark, tmp_path):
    """From the files of an extract to the rows valid on a day, for a layer of its own and one that holds others' objects."""
    lasting = "<Historie:eindGeldigheid>2015-01-01</Historie:eindGeldigheid>"
    known = "<Historie:BeschikbaarLV><Historie:tijdstipRegistratieLV>2010-02-03T04:05:06</Historie:tijdstipRegistratieLV></Historie:BeschikbaarLV>"
    square = polygon("0 0 0 4 0 0 4 4 0 0 4 0 0 0 0")
    for folder, code in (("pand", "PND"), ("inactief", "INACTIEF")):
        at = tmp_path / f"9999{code}08102022"
        at.mkdir()
        for n, more in enumerate(("", lasting)):
            one = OBJECT.format(id=f"{folder}{n}", geom=square).replace("</Historie:Voorkomen>", f"{more}{known}</Historie:Voorkomen>")
            (at / f"{n}.xml").write_text(PAND.format(one))
    for layer, kind in (("pand", None), ("Inactief", "pand")):
        rows = RG.read_register_layer(spark, str(tmp_path), layer, "08102022", kind)
        got = H.layer_snapshot(rows, "pand", H.reference_date("2020-01-01")).collect()
        assert [r.identificatie for r in got] == [f"NL.IMBAG.Pand.{layer.lower()}0"] and got[0].oorspronkelijkbouwjaar == 1907
        assert got[0].fid == rows.filter("eindgeldigheid IS NULL").first().ogc_fid and len(got[0].geometrie.parts) == 1
    now = reconstruction.current_buildings(RG.read_register_layer(spark, str(tmp_path), "pand", "08102022"), H.reference_date("2020-01-01"))
    assert [len(r.rings) for r in now.collect()] == [1]


@pytest.mark.parametrize("layer", sorted(RG.LAYER_CODES))
def test_every_layer_has_a_folder_and_a_reader(spark, tmp_path, layer):
    kind = layer if layer in RG.LAYER_ELEMENTS else "ligplaats"
    at = tmp_path / f"9999{RG.LAYER_CODES[layer].upper()}01012024"
    at.mkdir()
    name = RG.LAYER_ELEMENTS[kind]
    (at / "a.xml").write_text(f'<s xmlns:o="o"><o:{name}><o:identificatie domein="NL.IMBAG.{name}">5</o:identificatie></o:{name}></s>')
    got = RG.read_register_layer(spark, str(tmp_path), layer, "01012024", kind).first()
    assert got.identificatie == f"NL.IMBAG.{name}.5" and got.ogc_fid is not None


def test_units_refer_to_buildings(spark):
    xml = """<Objecten:Verblijfsobject xmlns:Objecten="o" xmlns:g="g" xmlns:r="r"><Objecten:identificatie domein="NL.IMBAG.Verblijfsobject">7</Objecten:identificatie>
    <Objecten:geometrie><Objecten:punt><g:Point><g:pos>1.5 2.5 0</g:pos></g:Point></Objecten:punt></Objecten:geometrie>
    <Objecten:gebruiksdoel>woonfunctie</Objecten:gebruiksdoel><Objecten:gebruiksdoel>winkelfunctie</Objecten:gebruiksdoel><Objecten:oppervlakte>80</Objecten:oppervlakte>
    <Objecten:maaktDeelUitVan><r:PandRef domein="NL.IMBAG.Pand">1</r:PandRef><r:PandRef domein="NL.IMBAG.Pand">2</r:PandRef></Objecten:maaktDeelUitVan></Objecten:Verblijfsobject>"""
    r = RG.parse_register(spark.createDataFrame([(xml,)], "xml string"), "verblijfsobject").first()
    assert r.pandref == ["NL.IMBAG.Pand.1", "NL.IMBAG.Pand.2"] and r.gebruiksdoel == ["woonfunctie", "winkelfunctie"]
    assert (r.oppervlakte, r.point.x, r.point.y) == (80, 1.5, 2.5)


def test_gml_layer(spark, tmp_path):
    text = f"""<t:c xmlns:t="t" xmlns:gml="g"><t:Gebouw><t:lokaalid>12</t:lokaalid><t:typegebouw>kas, warenhuis</t:typegebouw>
    <t:geometrieVlak>{polygon("0 0 2 0 2 2 0 0")}</t:geometrieVlak></t:Gebouw></t:c>"""
    (tmp_path / "g.gml").write_text(text)
    r = SO.read_gml_layer(spark, str(tmp_path / "g.gml"), "Gebouw", "lokaalid int, typegebouw array<string>").first()
    assert r.lokaalid == 12 and r.typegebouw == ["kas, warenhuis"] and len(r.geometry) == 1


DOC = {"type": "CityJSONFeature", "id": "P1", "vertices": [[1, 2, 3]], "CityObjects": {
    "P1": {"type": "Building", "attributes": {"year": 1907, "s": "5", "flag": True, "h": 2.5, "none": None}, "geometry": [{"lod": "0"}]},
    "P1-0": {"type": "BuildingPart", "geometry": [{"lod": "2.2", "boundaries": [[[0]]]}]},
}}


def test_feature_files_round_trip(spark, tmp_path):
    folder = tmp_path / "in/6/240/8"
    folder.mkdir(parents=True)
    (folder / "P1.city.jsonl").write_text(json.dumps(DOC))
    docs = SO.read_features(spark, str(tmp_path / "in")).select("id", "doc").withColumn("tile_id", F.lit("t1"))
    values = spark.createDataFrame([("P1", 12.5, 3), ("gone", 1.0, 1)], "id string, a double, n int")
    new, misses = D.set_attributes(docs, values, {"a": "b3_opp_grond", "n": "b3_bouwlagen"})
    assert [r.id for r in misses.collect()] == ["gone"]
    sinks.write_features(new, str(tmp_path / "out"))
    back = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    want = json.loads(json.dumps(DOC))
    want["CityObjects"]["P1"]["attributes"].update(b3_opp_grond=12.5, b3_bouwlagen=3)
    assert back == want
    assert json.loads((folder / "P1.city.jsonl").read_text()) == DOC
    again, _ = D.set_attributes(new, values.withColumn("n", F.lit(None).cast("int")), {"n": "b3_bouwlagen"}, how="left")
    assert json.loads(again.first().doc)["CityObjects"]["P1"]["attributes"]["b3_bouwlagen"] is None
    index = SO.feature_file_index(spark, str(tmp_path / "in"), "tiles").first()
    assert (index.id, index.tile_id) == ("P1", "6/240/8")


def test_presence_shares_flags_within_a_file(spark):
    docs = spark.createDataFrame([(json.dumps(DOC),), (json.dumps({"CityObjects": {"Q": {"type": "Building"}}}),)], "doc string")
    got = {r.id: (r.lod_0, r.lod_12, r.lod_22, r.has_geometry) for r in D.lod_presence(docs).collect()}
    assert got == {"P1": (1, 0, 1, True), "P1-0": (1, 0, 1, True), "Q": (0, 0, 0, False)}
    alone = {r.id: (r.lod_0, r.lod_22) for r in D.lod_presence(docs, per_object=True).collect()}
    assert alone == {"P1": (1, 0), "P1-0": (0, 1), "Q": (0, 0)}


def test_two_boxes_share_a_wall(spark):
    def walls(x):
        z0, z1 = 0.0, 5.0
        ground = [(x, 0.0, z0), (x, 10.0, z0), (x + 10, 10.0, z0), (x + 10, 0.0, z0)]
        sides = [[(*a[:2], z0), (*b[:2], z0), (*b[:2], z1), (*a[:2], z1)] for a, b in zip(ground, ground[1:] + ground[:1])]
        return [("GroundSurface", ground), ("RoofSurface", [(a, b, z1) for a, b, _ in ground[::-1]])] + [("WallSurface", s) for s in sides]

    rows = [(name, i * 100 + k, kind, [*ring, ring[0]]) for i, (name, x) in enumerate((("a", 0.0), ("b", 10.0))) for k, (kind, ring) in enumerate(walls(x))]
    df = spark.createDataFrame(rows, "identificatie string, surface_id long, type string, ring array<struct<x:double,y:double,z:double>>")
    for r in D.surface_areas(df).collect():
        assert (r.area_ground, r.area_roof_flat, r.area_roof_sloped) == (100.0, 100.0, 0.0)
        assert r.area_shared_wall == pytest.approx(50.0) and r.area_exterior_wall == pytest.approx(150.0)


def turned_houses(degrees, names):
    """Box houses of 10 x 10 x 5 in a row, far from the origin."""
    cos, sin = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))

    def at(x, y, z):
        return 84_000 + x * cos - y * sin, 446_000 + x * sin + y * cos, z

    rows = []
    for i, name in enumerate(names):
        x = 10.0 * i
        ground = [(x, 0.0), (x, 10.0), (x + 10, 10.0), (x + 10, 0.0)]
        for k, (p, q) in enumerate(zip(ground, ground[1:] + ground[:1])):
            ring = [at(*p, 0.0), at(*q, 0.0), at(*q, 5.0), at(*p, 5.0)]
            rows.append((name, i * 100 + k, "WallSurface", [*ring, ring[0]]))
    return rows


@pytest.mark.parametrize("degrees", [0, 30, 30.4, 17.45, 90, 179.9])
def test_walls_of_any_direction_are_shared_between_buildings_only(spark, degrees):
    ddl = "identificatie string, surface_id long, type string, ring array<struct<x:double,y:double,z:double>>"
    got = {r.identificatie: (round(r.area_shared_wall, 3), round(r.area_exterior_wall, 3)) for r in D.surface_areas(spark.createDataFrame(turned_houses(degrees, "ab"), ddl)).collect()}
    assert got == {"a": (50.0, 150.0), "b": (50.0, 150.0)}
    inner = D.surface_areas(spark.createDataFrame(turned_houses(degrees, "aa"), ddl)).first()
    assert inner.area_shared_wall == 0


def test_many_small_files_are_written_by_tasks(spark, tmp_path, monkeypatch):
    """a file for each value of the keys, with the names and lines of Spark's own writer, in one folder for each first key."""
    rows = [("a", str(i), f"line {i}") for i in range(300)] + [("a", "7", "line 7"), ("b", "x/y=1%", "ü"), ("b", None, "n"), (None, "1", None), ("", "2", "e")]
    df = spark.createDataFrame(rows, "format string, tile_id string, line string")
    sinks.write_texts(df, str(tmp_path / "w"), ["format", "tile_id"], "line")
    df.repartition(1).write.partitionBy("format", "tile_id").text(str(tmp_path / "s"))
    with monkeypatch.context() as m:
        m.setattr(sinks, "mounted", lambda *_: None)
        sinks.write_texts(df, f"{tmp_path}/h", ["format", "tile_id"], "line")
    read = lambda at, of: {of(p.relative_to(at)): p.read_text() for p in at.rglob("*.txt")}
    want = read(tmp_path / "s", lambda p: str(p.parent))
    assert len(want) == 304 and read(tmp_path / "w", lambda p: str(p)[:-4]) == want == read(tmp_path / "h", lambda p: str(p.parent))
    assert len([p for p in (tmp_path / "w").rglob("*") if p.is_dir()]) == 3
    assert not [p for p in (tmp_path / "w").rglob("*") if p.is_file() and p.suffix != ".txt"]
    assert FI.read_file_hashes(spark, str(tmp_path / "w"), "*.txt").count() == 304
    assert sinks.mounted(spark, "file:/a%20b/c") == "/a b/c" and sinks.mounted(spark, "/a:b/c") == "/a:b/c" and sinks.mounted(spark, "s3a://b/c") is None


def test_features_of_large_files_are_read_by_lines(spark, tmp_path):
    """a file of many documents is read by several tasks, one of a single document is as it lies on disk."""
    at = tmp_path / "f"
    at.mkdir()
    one = lambda i, **how: json.dumps({"CityObjects": {f"P{i}": {"x": "a" * 200}}}, **how)
    (at / "many.txt").write_text("\n".join(f"{one(i)}\n" for i in range(3000)))
    (at / "line.city.jsonl").write_text(one(7001))
    singles = {"a": one(7002, indent=2), "b": one(7003, indent=2) + "\n", "c": "\n" + one(7004, indent=1) + "\n \n\n", "d": "\ufeff" + one(7005) + "\n", "e": one(7006) + "\r\n\r\n" + one(7007)}
    for name, text in singles.items():
        (at / f"{name}.city.jsonl").write_bytes(text.encode())
    for name, text in {"none": "", "blank": "\n \n"}.items():
        (at / f"{name}.txt").write_text(text)
    key, lone = "spark.sql.files.maxPartitionBytes", {r.path.rpartition("/")[2][0]: r.doc for r in SO.read_features(spark, str(at)).filter("path NOT LIKE '%many.txt' AND path NOT LIKE '%line.city.jsonl'").collect()}
    assert lone == singles
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64k")
        got = SO.read_features(spark, str(at)).filter("path LIKE '%many.txt'").select("id", "doc", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((r.id, r.doc) for r in got) == sorted((f"P{i}", one(i)) for i in range(3000))
    assert len({r.task for r in got}) > 1
    assert [r.id for r in SO.read_features(spark, str(at)).filter("path LIKE '%line.city.jsonl'").collect()] == ["P7001"]


def test_indented_files_and_lines(spark, tmp_path):
    (tmp_path / "r").mkdir()
    report = {"features": [{"id": "x", "validity": True, "primitives": []}, {"id": "y", "validity": False, "primitives": []}]}
    (tmp_path / "r/a.json").write_text(json.dumps(report, indent=2))
    assert sorted(r.id for r in SO.read_validation_reports(spark, str(tmp_path / "r")).collect()) == ["x", "y"]
    (tmp_path / "g").mkdir()
    square = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    shapes = {"features": [{"properties": {"id": "P"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}}, {"properties": {"id": "Q"}, "geometry": {"type": "Polygon", "coordinates": square}}]}
    (tmp_path / "g/a.geojson").write_text(json.dumps(shapes, indent=1))
    assert sorted(r.tile_id for r in SO.read_geojson(spark, str(tmp_path / "g"), "id").collect()) == ["p", "p", "q"]
    docs = spark.createDataFrame([("t", json.dumps({"CityObjects": {f"P{i}-0": {}, f"P{i}": {}}})) for i in range(3)], "tile_id string, doc string")
    sinks.write_features(docs, str(tmp_path / "f"))
    (tmp_path / "f/one.city.jsonl").write_text(json.dumps({"CityObjects": {"P9": {}}}, indent=2))
    assert sorted(r.id for r in SO.read_features(spark, str(tmp_path / "f")).collect()) == ["P0", "P1", "P2", "P9"]


def test_a_tile_has_one_file(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).selectExpr("concat('t', id % 5) AS tile_id", "id")
    sinks.write_tiles_gz(df, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("*/part-*"))) == 5
    sinks.write_tiles_gz(df, str(tmp_path / "s"), files=3)
    assert 5 <= len(list((tmp_path / "s").glob("*/part-*"))) <= 15


def test_archives(spark, tmp_path):
    with gzip.open(tmp_path / "a.city.json.gz", "wb") as f:
        f.write(b"x" * 3_000_000)
    whole = (tmp_path / "a.city.json.gz").read_bytes()
    (tmp_path / "cut.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "bad.gz").write_bytes(whole[:40] + bytes(255 - x for x in whole[40:60]) + whole[60:])
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("one.obj", "o x")
        z.writestr("two.obj", "o y")
    (tmp_path / "c.zip").write_bytes(b"no archive")
    from gevel.sources.files import read_archives

    got = {(r.path.rsplit("/", 1)[-1], r.member): (r.ok, r["size"]) for r in read_archives(spark, str(tmp_path)).collect()}
    assert got[("a.city.json.gz", "a.city.json")] == (True, 3_000_000)
    assert got[("bad.gz", "bad")][0] is False and got[("cut.gz", "cut")][0] is False and got[("c.zip", "")][0] is False
    assert got[("b.zip", "one.obj")] == (True, 3) and got[("b.zip", "two.obj")] == (True, 3)


def test_small_text_formats(spark, tmp_path):
    (tmp_path / "sums.txt").write_text("abc  a.laz\n\nb.laz\n")
    assert [tuple(r) for r in SO.read_checksums(spark, str(tmp_path / "sums.txt")).collect()] == [("a.laz", "abc"), ("b.laz", "")]
    (tmp_path / "quadtree.tsv").write_text("id\tlevel\tnr_items\tleaf\twkt\n10/1/2\t10\t5\ttrue\tPOLYGON ((0 0, 1 0, 1 1, 0 0))\n9/0/1\t9\t0\ttrue\t\n8/0/0\t8\t5\tfalse\t\n")
    from gevel.operators.tiling import leaf_tiles

    assert [r.id for r in leaf_tiles(SO.read_quadtree(spark, str(tmp_path / "quadtree.tsv"))).collect()] == ["10/1/2"]
    (tmp_path / "10-1-2-LoD12-3D.obj").write_text("# c\no NL.IMBAG.Pand.0307100000308298-0\nv 1 2 3\no other\n")
    obj = SO.read_obj_lines(spark, str(tmp_path)).first()
    assert (obj.tile_id, obj.lod, obj.identificatie) == ("10/1/2", "12", "NL.IMBAG.Pand.0307100000308298")
    with gzip.open(tmp_path / "run.json.gz", "wt") as f:
        json.dump({"event_list": [{"step_key": "s", "user_message": "m"}, {"step_key": "t", "user_message": "n"}]}, f)
    assert [r.value for r in SO.read_tool_logs(spark, str(tmp_path / "run.json.gz"), events=True, step="s").collect()] == ["m"]


def test_tables_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1, 2]), (2, "b", [])], "id int, s string, codes array<int>")
    assert sinks.replace_table(df, "t_features").count() == 3
    sinks.insert_ignore(spark.createDataFrame([(2, "z", [9]), (3, "c", None), (3, "c", None)], df.schema), "t_features", "id")
    assert sorted((r.id, r.s) for r in spark.table("t_features").collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert sinks.table_exists(spark, "t_features") and not sinks.table_exists(spark, "t_other")
    sinks.comment_table(spark, "t_features", "it's a table")
    more = spark.createDataFrame([(3, 'say "c"', None)], df.schema)
    sinks.write_csv(df.unionByName(more), str(tmp_path / "csv"), quote_text=True)
    text = {r.value for r in spark.read.text(str(tmp_path / "csv")).collect()}
    assert text == {'"id","s","codes"', '1,"a","[1, 2]"', '2,"b","[]"', '3,"say ""c""",""'}  # numbers are not quoted
    spark.sql("DROP TABLE t_features")


def test_rows_are_appended_and_tiles_read(spark, tmp_path):
    one = spark.createDataFrame([(1, "a")], "id int, s string")
    sinks.append_rows(one, "t_appended")
    sinks.append_rows(one, "t_appended")
    assert spark.table("t_appended").count() == 2 and SO.read_table(spark, "t_appended").count() == 2
    spark.sql("DROP TABLE t_appended")
    tile = {"type": "CityJSON", "CityObjects": {"P1": {"type": "Building", "attributes": {"a": 1}}, "P1-0": {"type": "BuildingPart", "geometry": [{"lod": "2.2"}]}}}
    at = tmp_path / "tiles" / "9" / "1" / "2"
    at.mkdir(parents=True)
    (at / "9-1-2.city.json").write_text(json.dumps(tile))
    rows = SO.read_cityjson_tile(spark, str(tmp_path / "tiles")).collect()
    assert rows and any("P1" in str(r) for r in rows)


def test_metadata_is_one_file(spark, tmp_path):
    sinks.write_metadata_json(spark.createDataFrame([('{"a":1}',)], "doc string"), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").glob("part-*"))) == 1


class Named:
    """A session whose settings name the folder."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder}


def test_shared_folder_is_taken_from_the_session(spark):
    assert shared_dir(Named("/shared/x")) == "/shared/x"
    assert shared_dir(spark) == shared_dir(spark)


def test_a_cluster_must_name_a_shared_folder():
    class Cluster:
        conf = {}

        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())


def test_cut_lineage_keeps_rows_and_reads_files(spark):
    df = cut_lineage(spark.range(5).withColumn("a", F.array("id")))
    assert df.count() == 5 and df.inputFiles()
