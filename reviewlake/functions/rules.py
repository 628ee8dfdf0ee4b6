"""Word lists, patterns, weights and thresholds.

These must equal the documented business rules for results to be right, so they
are stated as plain text and kept together. Nothing here is computed.
"""

# Sentiment terms; a review scores one point per term it contains.
POSITIVE_TERMS = (
    "excelente", "ótimo", "bom", "maravilhoso", "fantástico", "perfeito", "incrível",
    "satisfeito", "feliz", "contente", "agradável", "recomendo", "aprovado", "amei",
    "gostei", "adorei", "parabéns", "eficiente", "rápido", "prático", "fácil",
    "atencioso", "educado", "prestativo", "cordial", "profissional", "competente",
    "organizado", "limpo", "confortável", "seguro", "confiável", "qualidade",
)
NEGATIVE_TERMS = (
    "péssimo", "horrível", "ruim", "terrível", "desastroso", "lamentável", "decepcionante",
    "insatisfeito", "irritado", "chateado", "frustrado", "raiva", "ódio", "detesto",
    "não recomendo", "reprovado", "odiei", "problemático", "demorado", "lento", "difícil",
    "mal educado", "grosso", "incompetente", "desorganizado", "sujo", "desconfortável",
    "inseguro", "duvidoso", "baixa qualidade", "fraude", "golpe", "enganação",
)

# Shorter lists used by the scored variant.
SCORED_POSITIVE_TERMS = (
    "excelente", "ótimo", "bom", "maravilhoso", "fantástico", "perfeito",
    "satisfeito", "feliz", "recomendo", "gostei", "adorei", "eficiente",
)
SCORED_NEGATIVE_TERMS = (
    "péssimo", "horrível", "ruim", "terrível", "insatisfeito", "irritado",
    "não recomendo", "odiei", "problemático", "demorado", "incompetente",
)

# Personal-data patterns. "|" inside the e-mail class is a literal bar.
CPF_PATTERN = r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b"
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_PATTERN = r"(\(?\d{2}\)?[\s\-]?\d{4,5}[\s\-]?\d{4})"
MASK_PHONE_PATTERN = r"\(?\d{2}\)?\s?\d{4,5}-?\d{4}"
CEP_PATTERN = r"\b\d{5}-?\d{3}\b"

# (type, pattern, replacement), in the order they are applied.
PII_RULES = (
    ("cpf", CPF_PATTERN, "[CPF_ANONIMIZADO]"),
    ("email", EMAIL_PATTERN, "[EMAIL_ANONIMIZADO]"),
    ("telefone", PHONE_PATTERN, "[TELEFONE_ANONIMIZADO]"),
)
MASK_RULES = (
    ("cpf", CPF_PATTERN, "[CPF_MASCARADO]"),
    ("telefone", MASK_PHONE_PATTERN, "[TELEFONE_MASCARADO]"),
    ("email", EMAIL_PATTERN, "[EMAIL_MASCARADO]"),
    ("cep", CEP_PATTERN, "[CEP_MASCARADO]"),
)

# Reputational-risk categories: (name, weight in tenths per matching keyword, keywords).
RISK_CATEGORIES = (
    ("ATENDIMENTO", 8, ("mal atendido", "grosseiro", "ignorou", "desrespeitoso", "rude")),
    ("SISTEMA", 6, ("sistema fora", "não funciona", "travou", "erro no sistema")),
    ("SEGURANCA", 10, ("fraude", "golpe", "roubo", "clonaram", "hackearam")),
    ("FINANCEIRO", 9, ("cobrança indevida", "taxa abusiva", "juros altos", "não autorizei")),
    ("TEMPO", 5, ("demorou muito", "fila enorme", "esperei horas", "muito lento")),
)

# Patterns that call for immediate attention, matched ignoring case.
CRITICAL_PATTERNS = (
    ("DISCRIMINACAO", r"\b(racis|preconceito|discrimina)\w*\b"),
    ("AMEACA", r"\b(vou processar|ação judicial|advogado|justiça)\b"),
    ("PROBLEMA_GRAVE", r"\b(perdeu meu dinheiro|sumiu|desapareceu)\b"),
)

SENTIMENTS = ("positivo", "negativo", "neutro")

# Neighbourhoods in the order they are worked through.
BAIRROS = (
    "Vila Madalena", "Pinheiros", "Itaim Bibi", "Moema", "Vila Olímpia", "Brooklin",
    "Campo Belo", "Saúde", "Liberdade", "Bela Vista", "Consolação", "Higienópolis",
    "Jardins", "Cerqueira César", "Paraíso", "Vila Mariana", "Aclimação", "Cambuci",
    "Vila Prudente", "Ipiranga", "Santana", "Vila Guilherme", "Tucuruvi", "Mandaqui",
    "Casa Verde", "Limão", "Barra Funda", "Água Branca", "Perdizes", "Pompeia", "Lapa",
    "Vila Leopoldina", "Jaguaré", "Butantã", "Morumbi", "Vila Sônia", "Campo Limpo",
    "Capão Redondo", "Jardim São Luís", "M'Boi Mirim", "Cidade Ademar", "Pedreira",
    "Cidade Dutra", "Grajaú", "Jabaquara", "Cidade Monções", "Socorro", "Vila Andrade",
    "Santo Amaro", "Chácara Santo Antônio", "Granja Julieta", "Jurubatuba",
)

# Values that stand in for what a landed record lacks.
DEFAULTS = {
    "name": "Local Desconhecido",
    "formatted_address": "Endereço não informado",
    "latitude": 0.0,
    "longitude": 0.0,
    "rating": 0.0,
    "total_avaliacoes": 0,
    "bairro_pesquisado": "centro",
    "author_name": "Anônimo",
    "review_rating": 0,
    "review_text": "",
    "review_time": 0,
}

# Branch and neighbourhood acceptance criteria.
CRITERIA = {
    "min_agencias": 1,
    "max_agencias": 50,
    "required": ("place_id", "name", "formatted_address", "geometry", "types"),
    "rating_min": 1.0,
    "rating_max": 5.0,
    "min_score": 0.7,
}

# Column ranges; None leaves a side open.
RANGE_RULES = (
    ("rating_agencia", 1.0, 5.0),
    ("review_rating", 1.0, 5.0),
    ("sentimento_score", 0.0, 1.0),
    ("latitude", -90.0, 90.0),
    ("longitude", -180.0, 180.0),
    ("total_avaliacoes", 0.0, None),
)
FORMAT_RULES = (("place_id", r"^ChIJ[a-zA-Z0-9_-]+$"),)
DATE_COLUMNS = ("data_coleta",)
REQUIRED_COLUMNS = (
    "place_id", "agencia_name", "bairro_pesquisado", "data_coleta", "bronze_review_id",
)
LENGTH_RULES = (("review_text", 5, 5000), ("author_name", 2, 100))

# (metric, minimum percentage, whether the minimum itself passes, action when violated)
THRESHOLDS = (
    ("completude", 95.0, False, "alerta"),
    ("unicidade", 100.0, True, "falha"),
    ("schema", 100.0, True, "falha"),
    ("range", 98.0, False, "alerta"),
    ("formato", 99.0, False, "alerta"),
)

# layer -> (days kept, what happens afterwards)
RETENTION = {
    "landing": (30, "excluir"),
    "bronze": (90, "excluir"),
    "silver": (730, "anonimizar"),
    "gold": (1825, "agregados"),
}

# (column, class, sensitivity, treatment)
CLASSIFICATION = (
    ("place_id", "Não pessoal", "Baixa", "Armazenamento normal"),
    ("agencia_name", "Não pessoal", "Baixa", "Armazenamento normal"),
    ("author_name", "Dado pessoal", "Média", "Anonimização obrigatória"),
    ("review_text", "Dado pessoal", "Média", "Análise PII + anonimização"),
    ("latitude", "Não pessoal", "Baixa", "Armazenamento normal"),
    ("longitude", "Não pessoal", "Baixa", "Armazenamento normal"),
    ("rating", "Não pessoal", "Baixa", "Armazenamento normal"),
)
