"""Labels, column names and formats that published tables depend on.

They are facts of the data model, not choices of this library, and must stay as they are.
"""

# Person labels and the role of every row in the insured table.
NATURAL_PERSON_CODE = "F"
NATURAL_PERSON_LABEL = "Fisica"
LEGAL_PERSON_LABEL = "Moral"
INSURED_ROLE = "ASEGURADO"

# A broken encoding upstream stores the letter as a mark.
BROKEN_MARK = "#"
REPAIRED_LETTER = "Ñ"

# Columns of the policy object table that the insured table uses.
POLICY_COLUMNS = ["num_poliza", "num_version", "cve_filiacion"]

# Columns of the party master that the insured table uses, key first.
MASTER_KEY = "cdfiliac"
MASTER_COLUMNS = ["cdrfc", "tcpefiju", "dnnomrzm", "dnap1rzm", "dnap2rzm", "tscdc"]

# Columns of the contact table that the insured table carries over, key first.
CONTACT_KEY = "cve_filiacion"
CONTACT_COLUMNS = [
    "calle",
    "numero",
    "ref_adicional_domicilio",
    "cvecolonia",
    "colonia",
    "delegacion_o_municipio",
    "entidad_federativa",
    "codigo_postal",
    "codigo_pais",
    "correo_electronico",
    "tipo_comunicacion_1",
    "numero_prefijo_pais_1",
    "numero_prefijo_celular_1",
    "numero_prefijo_ciudad_1",
    "numero_telefono_1",
    "numero_extension_telefono_1",
    "tipo_comunicacion_2",
    "numero_prefijo_pais_2",
    "numero_prefijo_celular_2",
    "numero_prefijo_ciudad_2",
    "numero_telefono_2",
    "numero_extension_telefono_2",
]

# The insured table, in output order.
INSURED_COLUMNS = [
    "num_poliza",
    "num_version",
    "cve_asegurado",
    "rfc",
    "tipo_participante",
    "desc_tipo_persona",
    "nombre",
    "primer_apellido",
    "segundo_apellido",
    "nombre_completo",
    "ind_rol",
    *CONTACT_COLUMNS,
    "tscdc",
]

# Load modes, the fields of a load event, and directory names.
FULL = "full"
DELTA = "delta"
LOAD_EVENT_FIELDS = ["table", "tipo_carga", "date"]
DATA_DIR = "data"
SNAPSHOT_DIR = "data_bk"
BACKUP_NAME = "{layer}-respaldo-{mode}-{date}"

# Kinds of change between two snapshots, and their column.
CHANGE_COLUMN, INSERT, UPDATE, DELETE = "change", "insert", "update", "delete"
