"""Readers, writers and the whole design on invented files."""

import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from tilewright.params import Params
from tilewright.plans.design import Phases, design, select_probes
from tilewright.sources import fasta, gff, newick, tables

FLIP = str.maketrans("ACGT", "TGCA")


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x first one\nACGT\nAC\n>y\r\nGG\r\n\n>z\n")
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">q >odd\nTT\n")
    got = {r.id: (r.description, r.seq) for r in fasta.read_fasta(spark, [str(tmp_path / "a.fa"), str(tmp_path / "b.fa.gz")]).collect()}
    assert got == {"x": ("first one", "ACGTAC"), "y": ("", "GG"), "z": ("", ""), "q": (">odd", "TT")}
    df = spark.createDataFrame([("s", "A" * 130, "d d"), ("t", "C", "")], "id string, seq string, description string")
    fasta.write_fasta(df, str(tmp_path / "out"))
    back = {r.id: (r.description, r.seq) for r in fasta.read_fasta(spark, str(tmp_path / "out")).collect()}
    assert back == {"s": ("d d", "A" * 130), "t": ("", "C")}
    assert max(len(x) for p in (tmp_path / "out").glob("part*") for x in p.read_text().split("\n")) <= 60


def genome(path, contigs, rows):
    text = "##gff-version 3\n#!note\n" + "".join("\t".join(map(str, r)) + "\n" for r in rows) + "##FASTA\n" + "".join(f">{n} x\n{s[:70]}\n{s[70:].lower()}\n" for n, s in contigs.items())
    (gzip.open(path, "wt") if str(path).endswith("gz") else open(path, "w")).write(text)


def test_gff(spark, tmp_path):
    rng = random.Random(0)
    c1, c2 = ("".join(rng.choice("ACGT") for _ in range(120)) for _ in range(2))
    rows = [("c1", "t", "gene", 1, 9, ".", "+", 0, "ID=skip"), ("c1", "t", "CDS", 11, 40, ".", "+", 0, "ID=g1;Name=abc-1"), ("c2", "t", "CDS", 5, 64, ".", "-", 0, "ID=g2;Name=abc-2"), ("c2", "t", "CDS", 70, 90, ".", "+", 0, "ID=g3")]
    genome(tmp_path / "G1.gff", {"c1": c1, "c2": c2}, rows)
    genome(tmp_path / "G2.gff.gz", {"c1": c2}, [("c1", "t", "CDS", 1, 6, ".", "+", 0, "ID=h1;Name=xyz")])
    (tmp_path / "list.tab").write_text(f"{tmp_path}/G1.gff\ttaxon1\r\n{tmp_path}/G2.gff.gz\n{tmp_path}/other.gff\ttaxon1\n")
    listed = gff.read_genome_list(spark, str(tmp_path / "list.tab"))
    genomes = sorted((r.path, r.taxon_id) for r in listed.collect())
    assert genomes == [(f"{tmp_path}/G1.gff", "taxon1"), (f"{tmp_path}/G2.gff.gz", "G2")]
    got = {r.gene_id: r for r in gff.read_genes(spark, genomes, "[a-z]+").collect()}
    assert set(got) == {"g1", "g2", "g3", "h1"} and got["g1"].seq == c1[10:40] and got["g2"].seq == c2[4:64].translate(FLIP)[::-1]
    assert got["g1"].family == got["g2"].family == "abc" and got["g3"].family == "UNKNOWN" and got["g2"].uid == "g2.taxon1.2" and got["h1"].seq == c2[:6]


def test_newick(spark, tmp_path):
    text = "((a:1,b:2)x:0.5,'c d'[note],(e,f));"
    rows = newick.parse(text)
    assert [n for n, _, leaf in rows if leaf] == ["a", "b", "c d", "e", "f"] and dict((n, p) for n, p, _ in rows)["a"] == "x"
    assert newick.parse(newick.format_newick(rows)) == sorted(rows, key=lambda r: [x[0] for x in newick.parse(newick.format_newick(rows))].index(r[0]))
    (tmp_path / "t.nwk").write_text("(a,b)r;")
    assert {r.node_id for r in newick.read_newick(spark, str(tmp_path / "t.nwk")).collect()} == {"a", "b", "r"}
    with pytest.raises(ValueError):
        newick.parse("((a,b)")


def test_tables(spark, tmp_path):
    (tmp_path / "i.tsv").write_text("TaxonID\tClusterID\tSeqID\tGeneID\tStart\tEnd\tStrand\nt\tc\ts\tg\t1\tx\t+\n")
    row = tables.read_named(spark, str(tmp_path / "i.tsv"), tables.CLUSTER_INFO, ("CIGAR",)).first()
    assert (row.ClusterID, row.Start, row.End, row.CIGAR) == ("c", 1, None, None)
    with pytest.raises(ValueError):
        tables.read_named(spark, str(tmp_path / "i.tsv"), tables.PROBE_INFO)
    (tmp_path / "r.tab").write_text("r1\tn\tc\t5\t3\tACG\nr1\tn\tc\t9\t3\tACG\n")
    assert tables.read_regions(spark, str(tmp_path / "r.tab")).first().pos == 5
    (tmp_path / "l.tab").write_text(">r1\t0\t4\n")
    assert tuple(tables.read_intervals(spark, str(tmp_path / "l.tab")).first()) == ("r1", 1, 6)
    (tmp_path / "h.tab").write_text("r1\t30\t90.0\t40\t11\nr1\t10\t99\t1\t10\n")
    assert [tuple(r) for r in tables.read_hits(spark, str(tmp_path / "h.tab"), 20, 75).collect()] == [("r1", 11, 41)]
    assert tables.parse_config("# c\n\na\t1\na\t2\nb c\n") == {"a": "2"} and tables.read_names(spark, "a,b") == ["a", "b"]
    (tmp_path / "n.txt").write_text("p\n\nq\n")
    assert tables.read_names(spark, f"@{tmp_path}/n.txt") == ["p", "q"]
    df = spark.createDataFrame([(x,) for x in (5, 3, 9)], "v int")
    assert {r.v: r.id for r in tables.numbered(df, ["v"], "BR_", 6).collect()} == {3: "BR_000000", 5: "BR_000001", 9: "BR_000002"}
    tables.write_table(df, str(tmp_path / "w"))
    assert spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "w")).count() == 3


def test_design_end_to_end(spark, tmp_path):
    rng = random.Random(11)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    shared, ab = dna(300), dna(300)
    change = lambda s, p: "".join(rng.choice("ACGT") if rng.random() < p else c for c in s)
    rows = []
    for t in "abcd":
        rows.append(("shared", f"s.{t}", t, change(shared, 0.02)))
        rows.append((f"own{t}", f"o.{t}", t, dna(400)))
        if t in "ab":
            rows.append(("ab", f"ab.{t}", t, change(ab, 0.02)))
    genes = spark.createDataFrame(rows, "family string, uid string, taxon_id string, seq string")
    black = spark.createDataFrame([("x", rows[1][3][100:200])], "id string, seq string")
    p = Params(probes=60, divergence=0.2)
    out = design(spark, genes, p, blacklists=[black], folder=str(tmp_path / "run"))
    placed = {r.cluster_id: (r.node_id, r.penetrance) for r in out["assignment"].collect()}
    assert placed["owna_00000"] == ("a", 100.0) and placed["shared_00000"][1] == 100.0
    seqs = {r.cluster_id: r.seq for r in out["clusters"].collect()}
    for r in out["candidates"].collect() + out["filtered"].collect():
        assert seqs[r.cluster_id][r.pos - 1 : r.pos - 1 + r.len] == r.seq and r.len >= 75 and r.pos >= 26
    assert not any(r.cluster_id == "owna_00000" and r.pos < 190 and r.pos + r.len > 110 for r in out["filtered"].collect()), "the blacklisted stretch is gone"
    probes = out["probes"].collect()
    assert probes and all(len(r.seq) == 75 and seqs[r.cluster_id][r.clust_pos - 1 : r.clust_pos + 74] == r.seq for r in probes)
    ids = [r.probe_id for r in probes]
    assert len(set(ids)) == len(ids) and min(ids) == "Probe_000000"
    phases = Phases(spark, str(tmp_path / "run"), key=p.digest())
    assert phases.run("probes", lambda: pytest.fail("finished phases aren't run again")).count() == len(probes)
    assert not Phases(spark, str(tmp_path / "run"), key=Params(probes=61, divergence=0.2).digest()).folder == phases.folder, "other parameters, other results"
    counts = {r.stage: r.regions for r in out["counts"].collect()}
    assert counts == {"candidates": out["candidates"].count(), "filtered": out["filtered"].count(), "probes": len(probes)}
    assert {r.region_id for r in out["filtered"].collect()} == {f"FBR_{i:06d}" for i in range(counts["filtered"])}
    node = {c: n for c, (n, _) in placed.items()}
    same = lambda w, v: sum(a == b for a, b in zip(w, v))
    others = lambda n: [v for c, t in seqs.items() if node[c] != n for u in (t, t.translate(FLIP)[::-1]) for v in (u[i : i + 75] for i in range(len(u) - 74))]
    for n in {r.node_id for r in out["candidates"].collect()}:
        far = others(n)
        for r in out["candidates"].where(F.col("node_id") == n).limit(2).collect():
            assert max(same(r.seq[:75], v) for v in far) <= p.max_identity
    modes = {"constant": Params(length=75, constant_tiling=True), "regions": Params(max_regions=1), "baits": Params(max_baits=2), "tuned": Params(auto_tune=True)}
    taken = {name: select_probes(out["filtered"], out["nodes"], q, 40).count() for name, q in modes.items()}
    assert taken["constant"] <= 40 and all(n > 0 for n in taken.values())
    assert select_probes(out["filtered"], out["nodes"], Params(), 0).count() > max(taken.values())


def test_result_files(spark, tmp_path):
    from tilewright.sources import fasta, outputs, tables

    placed = spark.createDataFrame([("n1", 1, "acgt"), ("n1", 2, "TTT"), ("n2", 1, "GG")], "node_id string, ord int, seq string")
    outputs.write_pseudo_genomes(placed.repartition(3), f"{tmp_path}/pseudo")
    text = "".join(open(p).read() for p in sorted(map(str, (tmp_path / "pseudo").glob("part-*"))))
    assert text == ">n1\nACGT\nn\nTTT\n>n2\nGG\n"
    clusters = spark.createDataFrame([("c1", "AC"), ("c2", "GG")], "cluster_id string, seq string")
    outputs.write_low_penetrance(clusters, spark.createDataFrame([("c1", "_LOWPEN_"), ("c2", "n")], "cluster_id string, node_id string"), f"{tmp_path}/low")
    assert [(r.id, r.seq) for r in fasta.read_fasta(spark, f"{tmp_path}/low").collect()] == [("c1", "AC")]
    found = spark.createDataFrame([("t", "c", "chr1", 5, 9, "+", "ACGTA"), ("t", "b", "chr1", 1, 3, "-", "TTT")], "taxon_id string, cluster_id string, chr string, start int, end int, strand string, seq string")
    outputs.write_targets(found, f"{tmp_path}/targets")
    assert [tuple(r) for r in fasta.read_fasta(spark, f"{tmp_path}/targets").select("id", "description", "seq").orderBy("id").collect()] == [("TGT_00000", "t | chr1 (1-3)- | b", "TTT"), ("TGT_00001", "t | chr1 (5-9)+ | c", "ACGTA")]
    with open(tmp_path / "one.fa", "w") as f:
        f.write(">a x\nACGT\n>b\nAC-T\n>a\nTTTT\n")
    one = f"{tmp_path}/one.fa"
    assert [(r.cluster_id, r.seq) for r in fasta.read_cluster_sequences(spark, one).orderBy("cluster_id").collect()] == [("a", "ACGT"), ("b", "AC-T")]
    assert fasta.read_alignment(spark, one).count() == 3 and len(fasta.read_blacklists(spark, f"{one}, {one}")) == 2
    for bad in (lambda: fasta.read_blacklists(spark, f"{one},{tmp_path}/none.fa"), lambda: tables.read_paths(spark, one)):
        with pytest.raises(FileNotFoundError):
            bad()
    with open(tmp_path / "two.fa", "w") as f:
        f.write(">a\nACG\n>b\nA\n")
    with pytest.raises(ValueError):
        fasta.read_alignment(spark, f"{tmp_path}/two.fa")
    with open(tmp_path / "paths", "w") as f:
        f.write(f"{one}\n\n")
    assert tables.read_paths(spark, f"{tmp_path}/paths") == [one]


def test_known_genes(spark, tmp_path):
    from tilewright.sources import gff

    seq = "ACGTTGCAAC" * 6
    with open(tmp_path / "g.gff", "w") as f:
        f.write(f"##gff-version 3\nc\tx\tCDS\t11\t20\t.\t+\t0\tID=a;Name=n\nc\tx\tCDS\t55\t60\t.\t-\t0\tID=b\n##FASTA\n>c\n{seq}\n")
    known = spark.createDataFrame([("b",), ("z",)], "gene_id string")
    r = gff.read_known_genes(spark, [f"{tmp_path}/g.gff"], known, 8).collect()
    assert [(x.gene_id, x.up, x.down) for x in r] == [("b", 0, 8)] and r[0].seq == seq[46:60].translate(str.maketrans("ACGT", "TGCA"))[::-1]


def test_command_line(spark, tmp_path):
    from tilewright.__main__ import main, params, parser

    args = parser().parse_args(["--genomes", "g", "--out", "o", "--gc-min", "25.5", "--constant-tiling"])
    p = params(args, "length\t80\ngc-min\t10\n# note\nauto-tune\ttrue\n")
    assert (p.length, p.gc_min, p.constant_tiling, p.auto_tune) == (80, 25.5, True, True) and "length\t80" in p.banner()
    rng = random.Random(31)
    for t in "xy":
        dna = "".join(rng.choice("ACGT") for _ in range(900))
        with open(tmp_path / f"{t}.gff", "w") as f:
            f.write(f"##gff-version 3\nc\ts\tCDS\t1\t600\t.\t+\t0\tID=g{t};Name=n{t}\n##FASTA\n>c\n{dna}\n")
    (tmp_path / "list").write_text("".join(f"{tmp_path}/{t}.gff\t{t}\r\n" for t in "xy"))
    (tmp_path / "black.fa").write_text(">b\n" + "ACGT" * 30 + "\n")
    main(["--genomes", f"{tmp_path}/list", "--out", f"{tmp_path}/out", "--blacklists", f"{tmp_path}/black.fa", "--probes", "40", "--summary", "--targets", "none,nx"])
    probes = fasta.read_fasta(spark, f"{tmp_path}/out/probes.fna").collect()
    info = tables.read_named(spark, f"{tmp_path}/out/probes.tsv", tables.PROBE_INFO).collect()
    assert probes and {r.id for r in probes} == {r.ProbeID for r in info} and all(len(r.seq) == 75 for r in probes)
    assert {r.GeneID for r in tables.read_cluster_info(spark, f"{tmp_path}/out/clusters.tsv").collect()} == {"gx.x.1", "gy.y.1"}
    assert newick.read_newick(spark, f"{tmp_path}/out/nodes.newick").where("is_leaf").count() == 2
    assert fasta.read_fasta(spark, f"{tmp_path}/out/pseudo_genomes.fna").count() >= 1
    got = {r.org: (int(r.probes), r["class"]) for r in spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/out/summary.tsv").collect()}
    assert set(got) == {"x", "y"} and sum(n for n, _ in got.values()) >= len(probes)
    genomes = {}
    for t in "xy":
        text = (tmp_path / f"{t}.gff").read_text()
        genomes[t] = text.split(">c\n")[1].strip()
    for overlap, flank in (("none", 0), ("probe", 10), ("context", 10), ("context", 0)):
        main(["targets", "--clusters", f"{tmp_path}/out/clusters.tsv", "--probes", f"{tmp_path}/out/probes.tsv", "--genomes", f"{tmp_path}/list", "--out", f"{tmp_path}/targets-{overlap}-{flank}", "--flank", str(flank), "--overlap", overlap])
        rows = fasta.read_fasta(spark, f"{tmp_path}/targets-{overlap}-{flank}").collect()
        assert rows and len(rows) == len({r.id for r in rows}) and all(r.id.startswith("TGT_0") for r in rows)
        for r in rows:
            taxon, place, _ = r.description.split(" | ")
            a, b = map(int, re.search(r"\((\d+)-(\d+)\)", place).groups())
            assert r.seq == genomes[taxon][a - 1 : b] and len(r.seq) >= 75
        if overlap == "none":
            assert len(rows) == len(probes)
    with pytest.raises(FileNotFoundError):
        main(["targets", "--clusters", f"{tmp_path}/nothing", "--probes", f"{tmp_path}/out/probes.tsv", "--genomes", f"{tmp_path}/list", "--out", f"{tmp_path}/t"])


def test_deep_trees_are_written():
    deep = [("n0", None, False)] + [(f"n{i}", f"n{i - 1}", False) for i in range(1, 3000)] + [(f"t{i}", f"n{i}", True) for i in range(3000)]
    assert sorted(newick.parse(newick.format_newick(deep))) == sorted(deep)
    assert newick.format_newick([("r", None, False), ("b c", "r", True), ("a", "r", True)]) == "(a,'b c')r;"
