"""Fixed values of the notice domain: schemas and word lists that results depend on."""

from __future__ import annotations

# --- fixed values -------------------------------------------------------------------
SOURCES = ["fapes", "finep", "conif", "prppg_ifes", "proex_ifes", "capes", "cnpq"]
#: Agency as written on a notice to its registry source.
AGENCY_SOURCES = {"FAPES": "fapes", "FINEP": "finep", "CONIF": "conif", "PRPPG/IFES": "prppg_ifes", "PROEX/IFES": "proex_ifes", "CAPES": "capes", "CNPQ": "cnpq"}
MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]
DEFAULT_OPENING = "2026-01-01"
OPENING_TOKENS = ["publicação", "publicacao"]
START_TOKENS = [
    "início do período do edital", "inicio do período do edital", "abertura das inscrições", "abertura das inscricoes", "abertura da inscrição", "abertura da inscricao",
    "inscrição", "inscricao", "manifestação de interesse", "manifestacao de interesse", "início", "inicio", "período", "periodo",
]
END_TOKENS = ["fim do período do edital", "fim do periodo do edital", "prazo para envio da proposta", "prazo para envio de propostas", "prazo para envio", "encerramento", "término", "termino"]
SCHEDULE_STOP_WORDS = ["de", "da", "do", "o", "a", "os", "as", "em", "para", "com", "no", "na"]
PERIOD_TOKENS = ["inscrição", "inscricao", "manifestação", "manifestacao", "interesse", "período", "periodo", "submiss", "envio", "fluxo"]
DOCUMENT_EXTENSIONS = ["pdf", "doc", "docx", "odt", "ods", "zip", "rar"]
GENERIC_TITLES = ["baixar", "clique aqui", "download", "pdf"]
CAPES_NEGATIVE = ["resultado", "manual", "flyer", "apresentacao", "cartao"]
PROEX_POSITIVE = ["edital", "chamada pública", "chamada publica", "retifica", "retificado"]
PROEX_NEGATIVE = ["resultado", "inscri", "matricul", "sorteio", "comunicado", "convoca", "recurso", "entrevista"]
PRPPG_POSITIVE = ["edital", "chamada pública", "chamada publica", "chamada", "retificado", "retificação", "retificacao"]
PRPPG_NEGATIVE = ["resultado", "ata", "portaria", "etapa", "anexo"]
FINEP_STOPS = ["Orçamento:", "**Orçamento**", "Disponibilização do sistema", "Data de Publicação:", "Data de publicação:"]
FINEP_PUBLISHED = r"(?iu)Data\s+de\s+[Pp]ublica[cç][aã]o\s*:\s*(\d{2}/\d{2}/\d{4})"
FINEP_DEADLINE = r"(?iu)Prazo\s+para\s+envio\s+de\s+propostas\s+até\s*:\s*(\d{2}/\d{2}/\d{4})"
FINEP_THEMES = r"(?isu)Tema\s*\(s\)\s*:\s*(.+?)(?=\s*Situacão|\s*Documentos|\n\s*\n[A-Z]|$)"
FINEP_DOCUMENT = r"\.pdf|\.odt|\.doc|\.pptx|\.odp|chamadas-publicas"
FAPES_BLOCKS = ["accordion-group", "panel-group", "item-edital"]
FAPES_DOCUMENT = r"\.pdf|\.doc|\.docx|\.xls|\.xlsx|\.zip|\.odt"
FINEP_CATEGORIES = ["divulgação de conhecimento", "extensão", "inovação"]
CATEGORY_WORDS = ["extensão", "pesquisa", "inovação"]
# ------------------------------------------------------------------------------------

ATTACHMENT = "struct<titulo:string,link:string,tipo:string>"
EVENT = "struct<evento:string,data:string>"
RAW_SCHEMA = (
    "title string, url string, source_category string, raw_agency string, raw_description string, pdf_content binary, document_type string, group_id string, is_main boolean, "
    f"attachments array<struct<title:string,url:string,document_type:string>>, raw_status string, raw_cronograma array<{EVENT}>, raw_tags array<string>, raw_anexos array<{ATTACHMENT}>"
)
DOMAIN_SCHEMA = f"nome string, `descrição` string, `orgão_fomento` string, categoria string, status string, data_abertura string, data_encerramento string, link string, cronograma array<{EVENT}>, tags array<string>, anexos array<{ATTACHMENT}>"
