"""Dictionaries the classifiers and resolvers use.

FIXED VALUES: everything below must equal the behaviour being reproduced
(membership, spelling and, where noted, order). They are stated as plain text
in their natural order and are not derived from any rule.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES -- platforms
# ---------------------------------------------------------------------------
# The 14 registry platforms, in dispatch order; the search site runs after them.
PLATFORMS = [
    "greenhouse", "lever", "ashby", "workday", "oracle", "eightfold", "taleo",
    "successfactors", "phenom", "bamboohr", "breezy", "recruitee", "jobvite",
    "talentplatform",
]
SEARCH_PLATFORM = "linkedin"
REQUIRED_REGISTRY_KEYS = ["company_name", "ats_platform", "board_slug"]

# ---------------------------------------------------------------------------
# FIXED VALUES -- title rules (whole-word, case-insensitive)
# ---------------------------------------------------------------------------
SENIOR_WORDS = ["senior", "staff", "principal", "lead", "manager", "director", "vp", r"head\s+of"]
INTERN_WORDS = ["intern", "internship", "co-?op"]
# Diagnostic only: a match and a miss both end as new_grad.

# ---------------------------------------------------------------------------
# FIXED VALUES -- geography
# ---------------------------------------------------------------------------
US_STATE_ABBREVS = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
]
US_STATE_NAMES = [
    "alabama", "alaska", "arizona", "arkansas", "california",
    "colorado", "connecticut", "delaware", "florida", "georgia",
    "hawaii", "idaho", "illinois", "indiana", "iowa", "kansas",
    "kentucky", "louisiana", "maine", "maryland", "massachusetts",
    "michigan", "minnesota", "mississippi", "missouri", "montana",
    "nebraska", "nevada", "new hampshire", "new jersey", "new mexico",
    "new york", "north carolina", "north dakota", "ohio", "oklahoma",
    "oregon", "pennsylvania", "rhode island", "south carolina",
    "south dakota", "tennessee", "texas", "utah", "vermont",
    "virginia", "washington", "west virginia", "wisconsin", "wyoming",
]
CA_PROVINCE_ABBREVS = ["ON", "QC", "BC", "AB", "MB", "SK", "NS", "NB", "NL", "PE", "NT", "YT", "NU"]
CA_PROVINCE_NAMES = [
    "ontario", "quebec", "british columbia", "alberta", "manitoba",
    "saskatchewan", "nova scotia", "new brunswick",
    "newfoundland", "prince edward island",
]
US_INDICATORS = ["united states", "usa", "u.s.", "u.s.a."]
CA_INDICATORS = ["canada", "can"]
CA_CITIES = [
    "toronto", "vancouver", "montreal", "montréal", "ottawa", "calgary",
    "edmonton", "winnipeg", "hamilton", "kitchener", "waterloo",
    "mississauga", "brampton", "markham", "london", "victoria", "halifax",
    "burnaby", "richmond", "gatineau", "kanata", "scarborough",
    "north york", "etobicoke", "vaughan", "oakville", "burlington",
    "guelph", "saskatoon", "regina", "fredericton", "moncton", "kelowna",
    "windsor", "laval", "longueuil", "sherbrooke", "barrie", "nepean",
]
US_CITIES = [
    "new york", "san francisco", "los angeles", "chicago", "seattle",
    "austin", "boston", "denver", "atlanta", "dallas", "houston",
    "miami", "philadelphia", "phoenix", "san diego", "san jose",
    "portland", "minneapolis", "detroit", "pittsburgh", "raleigh",
    "charlotte", "nashville", "mountain view", "palo alto", "sunnyvale",
    "cupertino", "menlo park", "redmond", "bellevue", "irvine",
    "santa monica", "brooklyn", "manhattan",
]
US_FLAG = "\U0001f1fa\U0001f1f8"
CA_FLAG = "\U0001f1e8\U0001f1e6"
ONSITE_WORDS = ["hybrid", "in-?office", "on-?site", "onsite"]

# ---------------------------------------------------------------------------
# FIXED VALUES -- role categories. ORDER MATTERS: the first group with any
# substring hit wins, title first, then department.
# ---------------------------------------------------------------------------
CATEGORY_NAMES = [
    "Software Engineering", "Engineering and Development", "Data Analysis",
    "Machine Learning and AI", "Accounting and Finance", "Management and Executive",
    "Sales", "Marketing", "Human Resources", "Product Management", "Business Analyst",
    "Creatives and Design", "Legal and Compliance", "Customer Service and Support",
    "Operations", "Consultant", "Other",
]
CATEGORY_KEYWORDS = [
    ("Machine Learning and AI", [
        "machine learning", "ml engineer", "ml scientist", "ai engineer",
        "ai/ml", "ml/ai", "ai & ml", " ml ", "ml intern", "artificial intelligence",
        "deep learning", "nlp", "natural language", "computer vision",
        "data scientist", "research scientist", "applied scientist",
        "applied science", "generative ai", " llm", "ai agent", "ai intern",
        "ai developer", "ai data", "ai research",
    ]),
    ("Data Analysis", [
        "data analyst", "data analysis", "data analytics", "business intelligence",
        "bi analyst", "bi developer", "analytics", "data engineer",
        "data warehouse", "data science", "quantitative analyst",
        "reporting analyst", "data governance", "data quality",
        "data and business intelligence",
    ]),
    ("Software Engineering", [
        "software", "developer", "swe", " sde", "full stack", "fullstack",
        "full-stack", "back end", "backend", "front end", "frontend",
        "web developer", "mobile developer", "ios developer",
        "android developer", "programmer", "applications engineer",
        "application developer", ".net", "java developer", "python developer",
    ]),
    ("Engineering and Development", [
        "mechanical engineer", "electrical engineer", "civil engineer",
        "hardware", "firmware", "embedded", "fpga", "asic", "rf engineer",
        "optical", "photonics", "validation", "manufacturing engineer",
        "process engineer", "systems engineer", "network engineer",
        "devops", "site reliability", "sre", "infrastructure",
        "platform engineer", "cloud engineer", "security engineer",
        "cybersecurity", "qa engineer", "quality engineer", "test engineer",
        "quality assurance", "qa ", "automation engineer", "controls engineer",
        "industrial engineer", "chemical engineer", "aerospace engineer",
        "structural engineer", "engineer", "engineering", "technician",
    ]),
    ("Management and Executive", [
        "chief", " ceo ", " cfo ", " coo ", " cto ", " ciso ",
        "vice president", " vp ", "executive director", "managing director",
        "general manager", "head of",
    ]),
    ("Accounting and Finance", [
        "accountant", "accounting", "finance", "financial", "audit",
        "auditor", "tax", "treasury", "controller", "bookkeep", "payroll",
        "fp&a", "investment", "actuarial", "mergers", "mergers and acquisitions",
        "m&a", "private equity", "venture capital", "private client", "wealth",
        "asset management", "capital markets", "assurance", "underwriting",
        "financial reporting",
    ]),
    ("Sales", [
        "sales", "account executive", "account manager", "bdr", "sdr",
        "business development", "account representative", "inside sales",
        "sales development", "sales enablement", "partner enablement",
        "customer development", "account services", "field sales",
    ]),
    ("Marketing", [
        "marketing", "growth", "seo", "sem", "brand", "communications",
        "social media", "content strategist", "content marketing",
        "content creation", "content management", "public relations",
        "publicity", "demand generation", "copywriter",
    ]),
    ("Human Resources", [
        "human resources", "recruiter", "recruiting", "talent acquisition",
        "people operations", "people & culture", "people and culture",
        "hr ", "hris", "compensation", "organizational development",
        "organizational learning", "talent development", "employee experience",
        "talent and culture", "talent et culture", "change management",
    ]),
    ("Product Management", [
        "product manager", "product owner", "program manager",
        "technical program", "product management", "project manager",
    ]),
    ("Business Analyst", [
        "business analyst", "strategy analyst", "business systems analyst",
    ]),
    ("Creatives and Design", [
        "designer", "ux", "ui ", " ui", "graphic", "visual design",
        "product design", "interaction design", "creative", "illustrator",
        "animator", "artist", "video editor",
    ]),
    ("Legal and Compliance", [
        "legal", "counsel", "attorney", "paralegal", "compliance",
        "regulatory", "lawyer",
    ]),
    ("Customer Service and Support", [
        "customer support", "customer success", "customer service",
        "support engineer", "technical support", "help desk", "service desk",
        "client support",
    ]),
    ("Operations", [
        "operations", "supply chain", "logistics", "procurement",
        "project coordinator", "warehouse", "fulfillment", "inventory",
        "buyer", "planner",
    ]),
    ("Consultant", [
        "consultant", "consulting", "advisory",
    ]),
]
DEFAULT_CATEGORY = "Other"

# ---------------------------------------------------------------------------
# FIXED VALUES -- URLs and domains
# ---------------------------------------------------------------------------
TRACKING_PARAMS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "source"]
MULTI_PART_TLDS = [
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au",
    "co.jp", "co.kr", "co.in", "co.nz", "co.za", "com.br", "com.mx",
    "com.sg", "com.hk", "com.tr",
]
NON_COMPANY_HOSTS = [
    "jobright.ai", "newgrad-jobs.com", "linkedin.com", "indeed.com",
    "glassdoor.com", "github.com", "greenhouse.io", "lever.co",
    "myworkdayjobs.com", "ashbyhq.com", "smartrecruiters.com",
    "icims.com", "taleo.net", "bit.ly", "google.com",
]
KNOWN_DOMAINS = {
    "pwc": "pwc.com", "deloitte": "deloitte.com", "kpmg": "kpmg.com",
    "ey": "ey.com", "accenture": "accenture.com", "mckinsey": "mckinsey.com",
    "capgemini": "capgemini.com", "jp morgan": "jpmorgan.com",
    "jpmorgan": "jpmorgan.com", "goldman sachs": "goldmansachs.com",
    "td bank": "td.com", "td": "td.com", "rbc": "rbc.com",
    "royal bank": "rbc.com", "cibc": "cibc.com", "bmo": "bmo.com",
    "scotiabank": "scotiabank.com", "national bank": "nbc.ca",
    "manulife": "manulife.com", "sun life": "sunlife.com",
    "wealthsimple": "wealthsimple.com", "meta": "meta.com",
    "facebook": "meta.com", "google": "google.com", "alphabet": "google.com",
    "amazon": "amazon.com", "aws": "amazon.com", "electronic arts": "ea.com",
    "bytedance": "bytedance.com", "tiktok": "tiktok.com", "twitter": "x.com",
    "snap": "snap.com", "snapchat": "snap.com", "hewlett packard enterprise": "hpe.com",
    "databricks": "databricks.com", "snowflake": "snowflake.com",
    "datadog": "datadoghq.com", "mongodb": "mongodb.com",
    "cockroachdb": "cockroachlabs.com", "dbt labs": "getdbt.com",
    "elastic": "elastic.co", "confluent": "confluent.io", "neon": "neon.tech",
    "shopify": "shopify.com", "kinaxis": "kinaxis.com", "ciena": "ciena.com",
    "blackberry": "blackberry.com", "mitel": "mitel.com", "coveo": "coveo.com",
    "clio": "clio.com", "fullscript": "fullscript.com", "cgi": "cgi.com",
    "openai": "openai.com", "anthropic": "anthropic.com", "nvidia": "nvidia.com",
    "salesforce": "salesforce.com", "oracle": "oracle.com", "adobe": "adobe.com",
    "intuit": "intuit.com", "spotify": "spotify.com", "discord": "discord.com",
    "figma": "figma.com", "notion": "notion.so", "bloomberg": "bloomberg.com",
    "palantir": "palantir.com", "coinbase": "coinbase.com",
    "robinhood": "robinhood.com", "doordash": "doordash.com",
    "roblox": "roblox.com", "tesla": "tesla.com", "spacex": "spacex.com",
    "ericsson": "ericsson.com", "nokia": "nokia.com", "fortinet": "fortinet.com",
    "geotab": "geotab.com", "jobber": "getjobber.com", "1password": "1password.com",
    "benevity": "benevity.com", "trulioo": "trulioo.com", "klue": "klue.com",
    "loopio": "loopio.com", "thinkific": "thinkific.com", "hootsuite": "hootsuite.com",
    "neo financial": "neofinancial.com", "achievers": "achievers.com",
    "pointclickcare": "pointclickcare.com", "alayacare": "alayacare.com",
    "workleap": "workleap.com", "faire": "faire.com", "flipp": "flipp.com",
    "later": "later.com", "canonical": "canonical.com",
}
NAME_NOISE_WORDS = [
    "inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "group",
    "holdings", "technologies", "technology", "tech", "solutions", "solution", "systems", "labs",
    "laboratories", "services", "service", "software", "the", "and", "of",
]
FAVICON_TEMPLATE = "https://www.google.com/s2/favicons?domain={domain}&sz=128"
GENERATED_LOGO_MARKERS = ["google.com/s2", "clearbit", "icon.horse", "apistemic", "hunter.io"]

# ---------------------------------------------------------------------------
# FIXED VALUES -- salary patterns (priority order), date formats, caps
# ---------------------------------------------------------------------------
SALARY_PATTERNS_BOARD = [
    r"\$[\d,]+(?:\.\d+)?\s*[-–to]+\s*\$[\d,]+(?:\.\d+)?(?:\s*/\s*(?:yr|year|hr|hour|annually|monthly))?",
    r"\$[\d,]+(?:\.\d+)?\s*/\s*(?:yr|year|hr|hour)",
    r"\$[\d,]+(?:\.\d+)?(?:K)?\s*[-–]\s*\$[\d,]+(?:\.\d+)?(?:K)?",
]
SALARY_PATTERNS_POSTINGS = [
    r"\$[\d,]+(?:\.\d+)?\s*[-–to]+\s*\$[\d,]+(?:\.\d+)?(?:\s*/\s*(?:yr|year|hr|hour|annually))?",
    r"\$[\d,]+(?:\.\d+)?\s*/\s*(?:yr|year|hr|hour)",
]
SALARY_METADATA_WORDS = ["salary", "compensation", "pay"]
# Multi-format posted dates, tried in order (strptime spellings and their Spark equivalents).
DATE_FORMATS = [("%b %d, %Y", "MMM d, yyyy"), ("%B %d, %Y", "MMMM d, yyyy"),
                ("%m/%d/%Y", "M/d/yyyy"), ("%Y-%m-%d", "yyyy-M-d"), ("%d/%m/%Y", "d/M/yyyy")]
STALENESS_DAYS = 30
EIGHTFOLD_NA_MARKERS = ["canada", "united states", "usa", "u.s."]
ORACLE_NA_COUNTRIES = ["US", "CA"]
# The eight searches of the search site: (keywords, location, geo id).
SEARCHES = [
    ("intern software engineer", "Canada", "101174742"),
    ("new grad software", "Canada", "101174742"),
    ("co-op developer", "Canada", "101174742"),
    ("junior engineer", "Canada", "101174742"),
    ("intern software engineer", "United States", "103644278"),
    ("new grad software", "United States", "103644278"),
    ("junior developer", "United States", "103644278"),
    ("entry level data analyst", "United States", "103644278"),
]
# Columns the sink owns with constant defaults.
SINK_DEFAULTS = {
    "easy_apply": 0, "status": "new", "match_score": 0, "requirements_met": 0,
    "requirements_total": 0, "match_summary": "", "requirements_detail": "[]",
    "company_size": "", "company_description": "", "experience_years_required": None,
    "skip_reason": "", "saved": 0, "experience_score": 0, "skill_score": 0,
    "industry_score": 0, "match_label": "", "applicant_count": None,
    "github_source_id": None, "last_viewed_at": None,
}
# URL schemes whose last path segment carries ;parameters.
USES_PARAMS = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
               "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel"]
