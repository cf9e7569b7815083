"""Fixed values as the oracle states them, apart from the engine's own.

A wrong value in ``callsheet.constants`` thus shows as a difference between a
query and its SQL.  Business data of the source system, in natural order.
"""

INACTIVE_ACCOUNT = "INA"
EXCLUDED_INT_1 = 400
DOWN_PAYMENT_MARK = "ENTRADA"
CPC_MARK = "CPC"
NEVER_CONTACTED_DAYS = 60

PAID_STATUSES = ["P", "G", "A"]
BROKEN_STATUSES = ["Q", "E"]
LABELLED_STATUSES = ["Q", "E", "P", "G", "A"]
STATUS_LABELS = [("A", "Em Acordo"), ("E", "Exceção Rejeitada"), ("G", "Pago"), ("Q", "Quebrado"), ("P", "Em Promessa")]
STATUS_LABEL_OTHER = "Sem Dados"
TYPE_SINGLE = "AVISTA"
TYPE_INSTALMENTS = "PARCELADO"

PHONE_SLOTS = 7
PHONE_STATUS_ORDER = [2, 4, 5, 6, 1, 0]
PHONE_GOOD_STATUSES = [2, 4, 5, 6, 1]
NOTE_ALWAYS_BAD = ["Desconhecido", "incorreto"]
NOTE_BAD_UNLESS_GOOD_STATUS = ["Descon", "incorret"]
NUMBER_BAD_CHAR = "X"
NUMBER_MIN_BYTES = 8

LIST_SEPARATOR = " || "
BRAND_MODEL_SEPARATOR = " - "
YEARS_SEPARATOR = "/"

PORTFOLIOS = [(517, "AutosPF"), (518, "DivZeroPF"), (519, "CedidasPF")]
DEFAULT_FILE_PREFIX = "AutosPF"
MAILINGS = [
    ("seg_quebras_rcs", "Quebras & Rejeitadas", "Contas com problemas de contato e execução de estratégias.", 0),
    ("ter_cpc", "CPC (Contato Pessoa Certa)", "Foco em estabelecer conexões efetivas com os responsáveis pelos débitos.", 1),
    ("qua_nunca_contatados", "Nunca Contatados", "Carteiras novas e clientes sem histórico de contato para maximizar alcance.", 2),
]
MAILING_FILE_SUFFIX = [("seg_quebras_rcs", "QuebrasRejeitadas"), ("ter_cpc", "CPC"), ("qua_nunca_contatados", "NuncaContatados")]
WEEKDAY_NAMES = ["Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado", "Domingo"]

OUTPUT_COLUMNS = [
    "cod_cad", "nome", "cpf", "bindingid", "datanascimento", "portfolio",
    "Telefone1", "Telefone2", "Telefone3", "Telefone4", "Telefone5", "Telefone6", "Telefone7",
    "MarcaModelo", "placa", "cor", "AnoFabModelo", "QtdGarantiasUnicas", "Contratos", "TipoProduto",
    "UltimoValorAcordado", "TipoAcordo", "DataCriacaoGecobi", "StatusUltimoAcordo",
]
