from conftest import rows
from reglink.functions import clean as C


def test_clean_text_pipeline(spark):
    df = spark.createDataFrame([("  av. Paulista,  #1000\t",), ("R  Sto. Antônio",), (" -- ",), (None,)], "s string")
    got = [r[0] for r in rows(df.select(C.clean_text("s").alias("c")))]
    assert got == ["AVENIDA Paulista 1000", "RUA SANTO Antônio", None, None]


def test_strip_whitespace_handles_tabs(spark):
    df = spark.createDataFrame([("\t a  b \n",)], "s string")
    assert rows(df.select(C.strip_whitespace("s"), C.strip_whitespace("s", squeeze=True))) == [("a  b", "a b")]


def test_standardize_date_layouts(spark):
    df = spark.createDataFrame([("2024-01-05",), ("05/01/2024",), ("20240105",), ("05.01.2024",), ("5 jan",)], "s string")
    got = [r[0] for r in rows(df.select(C.standardize_date("s").alias("d")))]
    assert got == ["2024-01-05"] * 4 + [None]


def test_expand_abbreviations_custom_map(spark):
    df = spark.createDataFrame([("st. mary RD",)], "s string")
    got = rows(df.select(C.expand_abbreviations("s", {"ST": "SAINT", "RD": "ROAD"})))
    assert got == [("SAINT mary ROAD",)]


def test_layout_regex_gates_only_numeric_layouts():
    assert C.layout_regex("dd/MM/yyyy") == r"^\d{2}/\d{2}/\d{4,}$"
    assert C.layout_regex("yyyyMMdd") == r"^\d{4}\d{2}\d{2}$"
    assert C.layout_regex("d/M/yyyy") == r"^\d{1,2}/\d{1,2}/\d{4,}$"
    assert C.layout_regex("dd MMM yyyy") is None


def test_standardize_date_single_digit_layout(spark):
    df = spark.createDataFrame([("5/1/2024",), ("05/01/2024",)], "s string")
    got = [r[0] for r in rows(df.select(C.standardize_date("s", formats=["d/M/yyyy"]).alias("d")))]
    assert got == ["2024-01-05", "2024-01-05"]


def test_clean_columns_in_place(spark):
    df = spark.createDataFrame([(1, " av.  Brasil ", "x")], "id int, street string, other string")
    out = C.clean_columns(df, ["street"])
    assert out.columns == ["id", "street", "other"]
    assert rows(out) == [(1, "AVENIDA Brasil", "x")]


def test_abbreviations_by_their_place(spark):
    want = {
        "JOAO R SILVA": "JOAO R SILVA",
        "R JOAO R SILVA": "RUA JOAO R SILVA",
        "av. Dr. Prof Lima": "AVENIDA DOUTOR PROFESSOR Lima",
        "DR JOAO": "DOUTOR JOAO",
        "MARIA DR": "MARIA DR",
        "R": "R",
        "AV": "AV",
        "R AV": "RUA AV",
        "Sto Antonio R": "SANTO Antonio R",
        "PRACA R": "PRACA R",
        "": "",
        "RUA DR": "RUA DR",
        "JD DR": "JARDIM DR",
    }
    df = spark.createDataFrame([(k,) for k in want] + [(None,)], "s string")
    got = {r.s: r.t for r in df.select("s", C.expand_street("s").alias("t")).collect()}
    assert got == {**want, None: None}
    # Without titles, without types, with neither.
    row = spark.createDataFrame([("R DR SILVA",)], "s string")
    assert rows(row.select(C.expand_street("s", titles={}), C.expand_street("s", types={}), C.expand_street("s", {}, {}))) == [("RUA DR SILVA", "R DOUTOR SILVA", "R DR SILVA")]
    assert rows(row.select(C.clean_text("s", abbreviations=None), C.clean_text("s", abbreviations={"SILVA": "SYLVA"}))) == [("R DR SILVA", "R DR SYLVA")]


def test_cleaned_rules_match_more(spark):
    from reglink.operators import link as L

    est = spark.createDataFrame([(1, " dr. Ana  R Lima", "av. brasil"), (2, "Joao R Silva", "R B"), (3, None, "x"), (4, "#", "y")], "CO_UNIDADE int, NO_FANTASIA string, NO_LOGRADOURO string")
    adr = spark.createDataFrame(
        [(7, "DOUTOR ANA R LIMA", "AVENIDA", None, "BRASIL"), (8, "JOAO R SILVA", "RUA", None, "B"), (9, "JOAO RUA SILVA", "RUA", None, "B"), (10, "!", "RUA", None, "C")],
        "COD_UNICO_ENDERECO int, DSC_ESTABELECIMENTO string, NOM_TIPO_SEGLOGR string, NOM_TITULO_SEGLOGR string, NOM_SEGLOGR string",
    )
    for clean, found in ((False, {}), (True, {1: 7, 2: 8})):
        rule = L.rule_by_name(L.registry_rules(clean=clean), "name_street")
        linked = L.link(est, adr, rule, right_id="COD_UNICO_ENDERECO").where("r_matches > 0")
        assert dict(rows(linked, "CO_UNIDADE", "r_first_id")) == found
