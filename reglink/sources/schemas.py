"""Declared schemas and naming rules of the two registries."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values -----------------------------------------------------------
# Address registry layout: field names, types and file order are those of the
# published census address files and must stay exactly as listed.
ADDRESS_FIELDS = [
    ("COD_UNICO_ENDERECO", "long"),
    ("COD_UF", "int"),
    ("COD_MUNICIPIO", "long"),
    ("COD_DISTRITO", "long"),
    ("COD_SUBDISTRITO", "long"),
    ("COD_SETOR", "string"),
    ("NUM_QUADRA", "int"),
    ("NUM_FACE", "int"),
    ("CEP", "string"),
    ("DSC_LOCALIDADE", "string"),
    ("NOM_TIPO_SEGLOGR", "string"),
    ("NOM_TITULO_SEGLOGR", "string"),
    ("NOM_SEGLOGR", "string"),
    ("NUM_ENDERECO", "int"),
    ("DSC_MODIFICADOR", "string"),
    ("NOM_COMP_ELEM1", "string"),
    ("VAL_COMP_ELEM1", "string"),
    ("NOM_COMP_ELEM2", "string"),
    ("VAL_COMP_ELEM2", "string"),
    ("NOM_COMP_ELEM3", "string"),
    ("VAL_COMP_ELEM3", "string"),
    ("NOM_COMP_ELEM4", "string"),
    ("VAL_COMP_ELEM4", "string"),
    ("NOM_COMP_ELEM5", "string"),
    ("VAL_COMP_ELEM5", "string"),
    ("LATITUDE", "double"),
    ("LONGITUDE", "double"),
    ("NV_GEO_COORD", "int"),
    ("COD_ESPECIE", "int"),
    ("DSC_ESTABELECIMENTO", "string"),
    ("COD_INDICADOR_ESTAB_ENDERECO", "string"),
    ("COD_INDICADOR_CONST_ENDERECO", "string"),
    ("COD_INDICADOR_FINALIDADE_CONST", "string"),
    ("COD_TIPO_ESPECI", "int"),
]

# Folder of one state: two digits, underscore, two capital letters (e.g. 11_RO).
STATE_FOLDER_REGEX = r"^\d{2}_[A-Z]{2}$"
STATE_FOLDER_GLOB = "[0-9][0-9]_[A-Z][A-Z]"

# Species code of health establishments in the address registry.
HEALTH_SPECIES = 5

# Establishment registry columns used by the linkage rules.
ESTABLISHMENT_ID = "CO_UNIDADE"
ESTABLISHMENT_NAME = "NO_FANTASIA"
ESTABLISHMENT_STREET = "NO_LOGRADOURO"
ESTABLISHMENT_NUMBER = "NU_ENDERECO"
ESTABLISHMENT_POSTAL = "CO_CEP"
ESTABLISHMENT_LAT = "NU_LATITUDE"
ESTABLISHMENT_LON = "NU_LONGITUDE"
# ----------------------------------------------------------------------------

_TYPES = {
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
}


def struct_from(fields: list[tuple[str, str]]) -> StructType:
    """Nullable StructType from (name, short type) pairs."""
    return StructType([StructField(n, _TYPES[t], True) for n, t in fields])


ADDRESS_SCHEMA = struct_from(ADDRESS_FIELDS)

# Address street parts composed into one street string (type, title, name).
ADDRESS_STREET_PARTS = ("NOM_TIPO_SEGLOGR", "NOM_TITULO_SEGLOGR", "NOM_SEGLOGR")
