from pyspark.sql import functions as F

import pytest

from winnow.functions.text import atom_ratios, largest_fragment, parse_list, prepare_text, solubility, token_profile
from winnow.operators.flags import range_flags
from winnow.sources import files, records, results
from winnow.streaming.rowlocal import apply_steps, write_stream

# Published strings with their heavy-atom counts.
HEAVY_ATOMS = [
    ("O=CC1=CCC(Br)=N1", 8),
    ("CSCC(=O)N[C@@H](C)C[S@@](C)=O", 12),
    (r"COc1cc(/C=C2\C(=O)N(C)C(=S)N2C)ccc1O", 19),
    ("CCN(CC)CCCC1CCN(C(=O)[C@@H]2[C@@H](C)C2(F)F)CC1", 22),
    ("CC45CC(O)C1C(CC=C2CC3(CCC12)OCCO3)C4CCC56OCCO6", 27),
    ("CCc1c(C)c2cc5nc(nc4[nH]c(cc3nc(cc1[nH]2)C(=O)C3(C)CC)c(CCC(=O)OC)c4C)C(C)(O)C5(O)CCC(=O)OC", 47),
    ("CC5CC(C)C(O)(CC4CC3OC2(CCC1(OC(C=CCCC(O)=O)CC=C1)O2)C(C)CC3O4)OC5C(Br)=C", 39),
]


def test_atom_tokens(spark):
    df = spark.createDataFrame(HEAVY_ATOMS, "smi string, atoms int")
    got = token_profile(df, "smi").collect()
    assert [r.heavy_atoms for r in got] == [r.atoms for r in got]
    br = got[0]
    assert (br.n_halogen, br.n_nitrogen, br.hetero_atoms, br.n_rings, br.n_bonds) == (1, 1, 3, 1, 8)
    assert br.symbols == ["Br", "C", "N", "O"]
    salt = token_profile(spark.createDataFrame([("[Na+].[13CH3]C(=O)[O-].[H]",), ("c1cc[nH]c1",), (None,)], "s string"), "s").collect()
    assert (salt[0].has_charge, salt[0].has_isotope, salt[0].n_fragments) == (True, True, 3)
    assert "Na" in salt[0].symbols and salt[0].heavy_atoms == 5
    assert (salt[1].n_aromatic, salt[1].n_nitrogen) == (5, 1)
    assert (salt[2].heavy_atoms, salt[2].n_fragments) == (0, 0)
    text = "F[C@@H](Cl)C(Br)(F)[C@](I)([F])N[35Cl]"
    r = token_profile(spark.createDataFrame([(text,), ("CCO",)], "s string"), "s").collect()
    assert [(x.n_F, x.n_Cl, x.n_Br, x.n_I, x.n_stereo, x.n_halogen) for x in r] == [(3, 2, 1, 1, 2, 7), (0, 0, 0, 0, 0, 0)]


def test_text_preparation(spark, rows):
    df = spark.createDataFrame([("[Na+].C[C@@H](N)C(=O)O",), (" CC.CN ",), ("NaN",), ("",), (None,)], "s string")
    out = [r[0] for r in df.select(prepare_text(F.col("s"))).collect()]
    assert out == ["C[CH](N)C(=O)O", "CC", None, None, None]
    assert df.select(largest_fragment(F.lit("C.CCC.CCN"))).first()[0] == "CCC"
    lists = spark.createDataFrame([("['C', 'N']",), ("oops",), (None,), ("[]",)], "s string")
    assert [r[0] for r in lists.select(parse_list(F.col("s"))).collect()] == [["C", "N"], [], [], []]
    r = atom_ratios(spark.createDataFrame([(1, 1, 4), (1, 1, 0)], "n_nitrogen int, n_sulfur int, heavy_atoms int")).collect()
    assert (r[0].fn_atoms, r[0].fns_atoms, r[1].fn_atoms) == (0.25, 0.5, 0.0)
    s = df.limit(1).select(solubility(F.lit(1.0), F.lit(100.0), F.lit(2.0), F.lit(6.0))).first()[0]
    assert abs(s - (0.16 - 0.63 - 0.62 + 0.132 - 4.44)) < 1e-12


def test_candidate_files(spark, rows, tmp_path):
    (tmp_path / "gen_a.v1.csv").write_text("SMILES,extra\nCCO,1\nCCN,2\n")
    (tmp_path / "gen_b.csv").write_text("smiles,name\nCCC,other\n")
    (tmp_path / "plain.txt").write_text("CCO\nCCN\n")
    one = files.read_candidates(spark, str(tmp_path / "gen_a.v1.csv"))
    assert rows(one, "smiles", "model_name", "extra") == [("CCN", "gen_a", "2"), ("CCO", "gen_a", "1")]
    both = files.read_candidates(spark, [str(tmp_path / "gen_a.v1.csv"), str(tmp_path / "gen_b.csv")])
    assert rows(both, "smiles", "model_name", "extra") == [
        ("CCC", "other", None), ("CCN", "gen_a", "2"), ("CCO", "gen_a", "1"),
    ]
    (tmp_path / "set").mkdir()
    (tmp_path / "set/a.csv").write_text("smiles,model_name,score\nCCO,m,1\n")
    (tmp_path / "set/b.csv").write_text("score,smiles,model_name\n2,CCN,n\n")
    (tmp_path / "set/c.csv").write_text("score,smiles,model_name\nbad,CCC,n\n")
    glob = files.read_candidates(spark, str(tmp_path / "set/*.csv"), schema="score double")
    assert rows(glob, "smiles", "model_name", "score") == [("CCC", "n", None), ("CCN", "n", 2.0), ("CCO", "m", 1.0)]
    with pytest.raises(ValueError, match="no column smiles"):
        files.read_candidates(spark, str(tmp_path / "plain.txt"))
    plain = files.read_candidates(spark, str(tmp_path / "plain.txt"), headerless=True)
    assert rows(plain, "smiles", "model_name") == [("CCN", "plain"), ("CCO", "plain")]
    assert files.count_records(spark, str(tmp_path / "gen_a.v1.csv"), "csv") == 2
    (tmp_path / "x.smi").write_text("CCO name\n\n  \nCCN\n")
    assert files.count_records(spark, str(tmp_path / "x.smi"), "smi") == 2
    assert rows(files.read_lines(spark, str(tmp_path / "x.smi"))) == [("CCN",), ("CCO",)]
    files.write_group_map(one.select("model_name").distinct(), str(tmp_path / "map"))
    assert spark.read.parquet(str(tmp_path / "map")).count() == 1


RECORD = """{name}
     tool          3D

  2  1  0  0  0  0  0  0  0  0999 V2000
    1.2500   -2.5000    3.7500 C   0  0  0
   -0.5000   10.1250   -9.0000 Cl  0  0  0
  1  2  1  0
M  END
{props}$$$$
"""


def test_pose_records(spark, rows, tmp_path):
    props = ">  <minimizedAffinity>\n{}\n\n> <s_model\\_name>\nm x\n\n> <s_model_name>\nlater\n\n"
    text = RECORD.format(name="mol-1", props=props.format("-8.4")) + RECORD.format(name="", props=props.format("-1"))
    text += RECORD.format(name="mol-2", props=props.format("bad") + "> <CNNscore>\n0.5\n\n")
    path = tmp_path / "poses.sdf"
    path.write_text(text)
    recs = records.read_records(spark, str(path))
    recs_before = recs.collect()
    first = recs.filter("name = 'mol-1'").first()
    assert recs.count() == 3 and first.props["s_model_name"] == "m x" and first.file == "poses"
    assert [(a.element, a.x, a.z) for a in first.atoms] == [("C", 1.25, 3.75), ("Cl", -0.5, -9.0)]
    scored = records.scored_records(recs, ["minimizedAffinity", "CNNscore"])
    assert rows(scored, "name", "affinity") == [("mol-1", -8.4), ("mol-2", 0.5)]
    assert files.count_records(spark, str(path), "sdf") == 3
    path.write_bytes(text.replace("\n", "\r\n").encode())
    same = records.read_records(spark, str(path))
    assert sorted(map(repr, same.collect())) == sorted(map(repr, recs_before))
    path.write_text(RECORD.format(name="n", props="> <remark>\nline one\nline two\n\n> <b>\n1\n\n"))
    assert records.read_records(spark, str(path)).first().props == {"remark": "line one\nline two", "b": "1"}


def test_site_atoms(spark, tmp_path):
    (tmp_path / "site.pdb").write_text(
        "HEADER    X\n"
        "ATOM      1  N   MET A   1      11.111  22.222 -33.333  1.00  0.00           N  \n"
        "HETATM    2 CL   LIG A   2      10.001  20.002 -30.003  1.00  0.00          CL  \n"
        "ATOM      3  CA  MET A   1      xx.xxx  20.002 -30.003  1.00  0.00           C  \n"
    )
    atoms = records.read_sites(spark, str(tmp_path / "site.pdb")).orderBy("x").collect()
    assert [(a.site_id, a.element, a.x) for a in atoms] == [("site", "Cl", 10.001), ("site", "N", 11.111)]


def test_results_and_logs(spark, rows, tmp_path):
    (tmp_path / "r.json").write_text('{"data": [{"index": 0, "target": "CCO", "is_solved": true, "search_time": 1.5, "top_score": 0.9}, {}]}')
    for name, body in (("empty", '{"data": []}'), ("missing", '{"x": 1}'), ("broken", "{not json")):
        (tmp_path / f"{name}.json").write_text(body)
        assert results.read_results(spark, str(tmp_path / f"{name}.json")).isEmpty()
    out = results.read_results(spark, str(tmp_path / "r.json")).select("index", "target", "is_solved", "search_time")
    assert rows(out) == [(-1, "", False, 0.0), (0, "CCO", True, 1.5)]
    (tmp_path / "tool.log").write_text("m1 | WARNING Outside Box\nm1 | not within box\nm2 | fine\noutside box, no id\n")
    assert rows(results.read_log(spark, str(tmp_path / "tool.log"))) == [(3, 1)]


def test_row_steps_on_a_stream(spark, rows, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 5.0), (2, 50.0), (3, None)], "id int, x double").write.parquet(src)
    stream = spark.readStream.schema("id int, x double").parquet(src)
    steps = [lambda d: range_flags(d, {"x": (1, 10)}), lambda d: d.filter("x_pass")]
    write_stream(apply_steps(stream, steps), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id") == [(1,)]
