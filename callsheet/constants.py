"""Fixed values that must equal the source system's for identical lists.

Everything here is business data of the campaign rules (codes, labels,
patterns, formats).  Kept together, in their natural order, as plain text.
"""

import datetime as dt

# ---- fixed values: campaign catalogue (id, title, description, weekday Mon=0)
MAILINGS = [
    ("seg_quebras_rcs", "Quebras & Rejeitadas", "Contas com problemas de contato e execução de estratégias.", 0),
    ("ter_cpc", "CPC (Contato Pessoa Certa)", "Foco em estabelecer conexões efetivas com os responsáveis pelos débitos.", 1),
    ("qua_nunca_contatados", "Nunca Contatados", "Carteiras novas e clientes sem histórico de contato para maximizar alcance.", 2),
]

# ---- fixed values: portfolio code -> file prefix (default AutosPF)
PORTFOLIOS = [
    (517, "AutosPF"),
    (518, "DivZeroPF"),
    (519, "CedidasPF"),
]
DEFAULT_FILE_PREFIX = "AutosPF"

# ---- fixed values: mailing id -> file suffix (default: the id itself)
MAILING_FILE_SUFFIX = [
    ("seg_quebras_rcs", "QuebrasRejeitadas"),
    ("ter_cpc", "CPC"),
    ("qua_nunca_contatados", "NuncaContatados"),
]

# ---- fixed values: weekday names, Monday=0
WEEKDAY_NAMES = ["Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado", "Domingo"]

# ---- fixed values: agreement rules
AGREEMENTS_SINCE = dt.date(2025, 7, 1)          # agreements created before this are ignored
PAID_STATUSES = ["P", "G", "A"]                  # latest status -> contract leaves every list
BROKEN_STATUSES = ["Q", "E"]                     # latest status -> "broken & rejected" list
LABELLED_STATUSES = ["Q", "E", "P", "G", "A"]    # latest status that gets the labels below
STATUS_LABELS = [
    ("A", "Em Acordo"),
    ("E", "Exceção Rejeitada"),
    ("G", "Pago"),
    ("Q", "Quebrado"),
    ("P", "Em Promessa"),
]
STATUS_LABEL_OTHER = "Sem Dados"
TYPE_SINGLE = "AVISTA"        # exactly one instalment
TYPE_INSTALMENTS = "PARCELADO"  # more than one instalment

# ---- fixed values: phone rules
PHONE_STATUS_ORDER = [2, 4, 5, 6, 1, 0]   # rank position; any other status (and NULL) sorts before all
PHONE_GOOD_STATUSES = [2, 4, 5, 6, 1]     # these statuses survive a "disconnected/incorrect" note
NOTE_ALWAYS_BAD = ["Desconhecido", "incorreto"]
NOTE_BAD_UNLESS_GOOD_STATUS = ["Descon", "incorret"]
NUMBER_BAD_CHAR = "X"
NUMBER_MIN_BYTES = 8
PHONE_SLOTS = 7

# ---- fixed values: account / contract rules
INACTIVE_ACCOUNT = "INA"
EXCLUDED_INT_1 = 400
DOWN_PAYMENT_MARK = "ENTRADA"
CPC_MARK = "CPC"
NEVER_CONTACTED_DAYS = 60

# ---- fixed values: output formats
DATE_FORMAT = "dd-MM-yyyy"
LIST_SEPARATOR = " || "
BRAND_MODEL_SEPARATOR = " - "
YEARS_SEPARATOR = "/"
RUN_STAMP_FORMAT = "yyyyMMdd_HHmmss"
CSV_DELIMITER = ";"

# Output layout of every list (24 columns, fixed order).
OUTPUT_COLUMNS = [
    "cod_cad", "nome", "cpf", "bindingid", "datanascimento", "portfolio",
    "Telefone1", "Telefone2", "Telefone3", "Telefone4", "Telefone5", "Telefone6", "Telefone7",
    "MarcaModelo", "placa", "cor", "AnoFabModelo", "QtdGarantiasUnicas",
    "Contratos", "TipoProduto",
    "UltimoValorAcordado", "TipoAcordo", "DataCriacaoGecobi", "StatusUltimoAcordo",
]
