"""Dimensions, weights, vocabularies and patterns that results must agree on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Criterion number, name, dimension, trusted domains.
CRITERIA = [
    (1, "Constitutional Protection", "legal", ["constituteproject.org", "hudoc.echr.coe.int", "venice.coe.int"]),
    (2, "Statutory Protection", "legal", ["eur-lex.europa.eu", "legislation.gov.uk", "boe.es"]),
    (3, "Privacy Enforcement", "enforcement", ["gdprhub.eu", "edpb.europa.eu", "ico.org.uk", "cnil.fr", "aepd.es"]),
    (4, "Identity Cards and Biometrics", "mixed", []),
    (5, "Data Sharing", "mixed", []),
    (6, "Visual Surveillance", "enforcement", ["privacyinternational.org", "eff.org"]),
    (7, "Communication Interception", "mixed", ["privacyinternational.org", "accessnow.org", "eff.org"]),
    (8, "Workplace Monitoring", "enforcement", []),
    (9, "Government Access to Data", "mixed", []),
    (10, "Communications Data Retention", "legal", ["eur-lex.europa.eu"]),
    (11, "Surveillance of Medical/Financial/Movement", "enforcement", ["privacyinternational.org"]),
    (12, "Border and Trans-border Issues", "enforcement", ["privacyinternational.org", "statewatch.org"]),
    (13, "Leadership", "legal", ["treaty.un.org", "coe.int"]),
    (14, "Democratic Safeguards", "enforcement", ["freedomhouse.org", "v-dem.net", "rsf.org"]),
]
#: Criteria with sub-scores.
SUBSCORED = (4, 5, 7, 9, 14)
#: Document type, criteria, dimension (None: generic extraction).
DOCUMENT_TYPES = [
    ("constitution", [1], "legal"),
    ("court_decision", [1, 14], "mixed"),
    ("data_protection_law", [2, 5, 9, 10], "legal"),
    ("regulation", [2], None),
    ("dpa_regulation", [2, 3], None),
    ("enforcement_report", [3], "enforcement"),
    ("dpa_annual_report", [3], "enforcement"),
    ("biometrics_id_law", [4], "mixed"),
    ("international_treaty", [5, 13], "legal"),
    ("surveillance_law", [6, 7, 11], "mixed"),
    ("data_retention_law", [7, 10], "legal"),
    ("workplace_privacy_law", [8], "enforcement"),
    ("government_access_law", [9], None),
    ("border_surveillance_law", [12], "enforcement"),
    ("dpa_reports", [], None),
    ("enforcement_records", [], None),
    ("regulatory_guidance", [], None),
    ("legislative_history", [], None),
]
#: Weight of a confidence; any other weighs DEFAULT_CONFIDENCE.
CONFIDENCE = {"high": 1.0, "medium": 0.7, "low": 0.4}
DEFAULT_CONFIDENCE = 0.4
#: Lower bounds of the index categories, on the unrounded score.
INDEX_BANDS = [
    (4.1, "Consistently upholds human rights standards"),
    (3.6, "Significant protections and safeguards"),
    (3.1, "Adequate safeguards against abuse"),
    (2.6, "Some safeguards but weakened protections"),
    (2.1, "Systemic failure to uphold safeguards"),
    (1.6, "Extensive surveillance societies"),
    (float("-inf"), "Endemic surveillance societies"),
]
#: Lower bounds of the sensitivity categories, on the rounded score.
SWEEP_BANDS = [
    (4.1, "4.1-5.0  Consistently upholds standards"),
    (3.6, "3.6-4.0  Significant protections"),
    (3.1, "3.1-3.5  Adequate safeguards"),
    (2.6, "2.6-3.0  Some safeguards (weakened)"),
    (2.1, "2.1-2.5  Systemic failure"),
    (1.6, "1.6-2.0  Extensive surveillance"),
    (float("-inf"), "1.1-1.5  Endemic surveillance"),
]
#: Lower bounds of the 0-100 categories.
PERCENT_BANDS = [(80, "Adequate protection"), (60, "Significant protections"), (40, "Systemic problems"), (20, "Extensive surveillance"), (float("-inf"), "Endemic surveillance")]
#: Weights of the legal dimension in the sensitivity sweep, and the baseline.
SCENARIOS, BASELINE = (1.0, 0.6, 0.5, 0.4, 0.3, 0.0), 0.4
#: Query sentence of each criterion.
QUERY_SENTENCES = {
    1: "Constitutional protection of privacy rights and court jurisprudence on data protection",
    2: "Data protection law rights of individuals obligations on data controllers",
    3: "Data protection authority enforcement actions sanctions fines independence",
    4: "National identity card biometric database fingerprint collection",
    5: "Secondary use of personal data inter-agency data sharing government programs",
    6: "CCTV surveillance cameras public spaces facial recognition regulation",
    7: "Communications interception wiretapping warrant judicial authorisation",
    8: "Workplace monitoring employee surveillance privacy protection",
    9: "Law enforcement access to personal data warrant requirement",
    10: "Mandatory data retention telecommunications traffic data period",
    11: "Medical records financial data location tracking surveillance protection",
    12: "Border control biometrics passenger name record international data sharing",
    13: "International treaty data sharing surveillance Budapest Convention Prum",
    14: "Parliamentary oversight judicial review executive surveillance democratic safeguards",
}
#: Structural noise of a section; each holds for one line, in any case.
NOISE = [
    r"\.{4,}",
    r"^\s*[\d\s\.\-–—]+\s*$",
    r"archived?\s+(content|notice|page)",
    r"this\s+(page|content|document)\s+(has\s+been|is)\s+archived",
    r"archiv[eé][e]?\s*[-–—]",
    r"©\s*\d{4}",
    r"all\s+rights\s+reserved",
    r"^(table\s+of\s+contents|contents|index|índice|sommaire|inhaltsverzeichnis)\s*$",
    r"(signed|signature)\s+by",
    r"in\s+witness\s+whereof",
    r"page\s+\d+\s+of\s+\d+",
    r"^\s*\d+\s*$",
    r"^[\s\-–—_=\*]{5,}$",
]
#: A text of SHORT_LINES lines or more is noise when over SHORT_SHARE of them have under SHORT_CHARS characters.
SHORT_LINES, SHORT_CHARS, SHORT_SHARE = 4, 60, 0.65
#: Starts of a section that hold in any language, and article labels of single languages.
SECTION_MARKS = ["\\d+\\.\\s", "\\d+\\.\\d+\\s", "§\\s*\\d+", "Art(?:icle|\\.)\\s*\\d+", "第\\d+条", "제\\d+조", "المادة\\s*\\d+", "Статья\\s*\\d+"]
ARTICLE_LABELS = {
    "es": "Art[íi]culo\\s+\\d+",
    "pt": "Artigo\\s+\\d+",
    "de": "(?:Artikel|§)\\s*\\d+",
    "fr": "Article\\s+\\d+",
    "it": "Articolo\\s+\\d+",
    "nl": "Artikel\\s+\\d+",
}
LEAST_SECTIONS, CHUNK = 3, 2000
#: Whole-word signal terms (stems match as prefixes), by language.
SIGNAL_STEMS = ["anonymi", "pseudonymi"]
SIGNAL_WORDS = [
    # English
    "personal data", "data protection", "privacy", "surveillance", "enforcement", "sanction", "fine", "penalty", "consent", "data subject", "controller", "processor",
    "retention", "interception", "biometric", "warrant", "judicial", "supervisory authority", "data breach", "transfer", "encryption", "lawful basis",
    # Spanish
    "datos personales", "protección de datos", "privacidad", "vigilancia", "sanción", "multa", "consentimiento", "titular", "responsable", "encargado", "retención",
    "interceptación", "biométrico", "autorización judicial", "autoridad de control", "brecha de datos", "transferencia", "cifrado", "anonimización", "seudonimización",
    # French
    "données personnelles", "protection des données", "vie privée", "amende", "consentement", "personne concernée", "responsable du traitement", "sous-traitant",
    "conservation", "biométrique", "mandat judiciaire", "autorité de contrôle", "violation de données", "transfert", "chiffrement", "anonymisation", "pseudonymisation",
    # German
    "personenbezogene daten", "datenschutz", "privatsphäre", "überwachung", "sanktion", "bußgeld", "einwilligung", "betroffene person", "verantwortlicher",
    "auftragsverarbeiter", "speicherung", "abhören", "biometrisch", "richtervorbehalt", "aufsichtsbehörde", "datenpanne", "übermittlung", "verschlüsselung",
    "anonymisierung", "pseudonymisierung",
    # Portuguese
    "dados pessoais", "proteção de dados", "privacidade", "vigilância", "sanção", "consentimento", "titular dos dados", "controlador", "operador", "retenção",
    "interceptação", "autorização judicial", "autoridade supervisora", "violação de dados", "transferência", "criptografia", "anonimização", "pseudonimização",
    # Russian
    "персональные данные", "защита данных", "конфиденциальность", "слежка", "санкция", "штраф", "согласие", "субъект данных", "оператор", "хранение", "перехват",
    "биометрический", "судебный ордер", "нарушение данных",
    # Vietnamese
    "dữ liệu cá nhân", "bảo vệ dữ liệu", "quyền riêng tư", "giám sát", "xử phạt", "phạt tiền", "đồng ý", "chủ thể dữ liệu", "bên kiểm soát", "xử lý dữ liệu",
    "lưu trữ dữ liệu", "chặn thu", "sinh trắc học", "cơ quan giám sát", "vi phạm dữ liệu", "chuyển dữ liệu", "mã hóa", "ẩn danh hóa", "an ninh mạng", "thông tin cá nhân",
]
#: Signal terms of scripts without word boundaries.
SIGNAL_PARTS = [
    # Chinese, simplified and traditional
    "个人数据", "数据保护", "隐私", "监控", "制裁", "罚款", "同意", "数据主体", "数据控制者", "保留", "拦截", "生物特征", "司法令状", "数据泄露", "传输",
    "個人資料", "資料保護", "隱私", "監控", "罰款", "資料主體", "資料控制者", "保存", "攔截", "生物特徵", "資料外洩", "傳輸", "個人資料保護", "資訊安全", "監察",
    # Arabic
    "البيانات الشخصية", "حماية البيانات", "الخصوصية", "المراقبة", "العقوبة", "الغرامة", "الموافقة", "سلطة الإشراف", "انتهاك البيانات",
    # Thai
    "ข้อมูลส่วนบุคคล", "การคุ้มครองข้อมูล", "ความเป็นส่วนตัว", "การเฝ้าระวัง", "บทลงโทษ", "ค่าปรับ", "ความยินยอม", "เจ้าของข้อมูล", "ผู้ควบคุมข้อมูล", "ผู้ประมวลผลข้อมูล",
    "การเก็บรักษา", "การดักฟัง", "ข้อมูลชีวภาพ", "หน่วยงานกำกับดูแล", "การละเมิดข้อมูล", "การโอนข้อมูล", "การเข้ารหัส", "การทำให้ไม่ระบุตัวตน", "ความมั่นคงปลอดภัย",
    # Korean
    "개인정보", "개인정보 보호", "사생활", "프라이버시", "감시", "제재", "과태료", "벌금", "동의", "정보주체", "개인정보처리자", "수탁자", "보유기간", "감청", "생체인식",
    "법원 명령", "감독기관", "개인정보 침해", "개인정보 이전", "암호화", "익명처리", "개인정보보호위원회", "정보통신망",
]
#: Status of a country report and its normalised values.
STATUS = {"Free": (5.0, 1.0), "Partly Free": (3.0, 0.6), "Not Free": (1.0, 0.2)}


def criteria(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CRITERIA, "criterion_number int, criterion_name string, dimension string, trusted_domains array<string>")


def document_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DOCUMENT_TYPES, "document_type string, criteria_ids array<int>, dimension string")


#: Frequent words that tell languages of Latin script apart.
STOP_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "mit", "von", "den", "des", "ein", "eine", "für", "auf", "dem", "im", "zu", "oder", "wird", "sich"],
    "en": ["the", "of", "and", "to", "is", "that", "for", "with", "by", "are", "this", "be", "on", "or", "shall", "must", "not", "any", "from", "which"],
    "es": ["el", "los", "las", "y", "del", "que", "una", "con", "por", "para", "se", "es", "al", "su", "como", "sobre", "cuando", "no", "este", "deberá"],
    "fr": ["le", "les", "et", "des", "du", "est", "une", "dans", "qui", "pour", "par", "sur", "au", "aux", "ou", "que", "avec", "ne", "pas", "son"],
    "it": ["il", "gli", "e", "di", "della", "che", "per", "con", "sono", "non", "nel", "alla", "dei", "le", "una", "è", "da", "del", "dal", "si"],
    "nl": ["de", "het", "een", "en", "van", "is", "dat", "niet", "met", "voor", "op", "te", "zijn", "aan", "door", "wordt", "of", "bij", "die", "over"],
    "pl": ["i", "w", "na", "nie", "się", "z", "do", "jest", "oraz", "przez", "dla", "od", "lub", "że", "po", "za", "o", "jak", "jeżeli", "który"],
    "pt": ["o", "os", "e", "do", "da", "dos", "das", "que", "não", "com", "uma", "para", "em", "no", "na", "por", "ao", "é", "ou", "se"],
}
