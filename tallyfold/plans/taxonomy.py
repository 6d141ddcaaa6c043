"""Rule tables of the job-title taxonomy. Data only."""

from __future__ import annotations

from tallyfold.functions.rules import PartRule, Rule

# Role-family rules, in order of precedence. Phrases already covered by a
# shorter phrase of the same rule are left out.
ROLE_RULES = (
    Rule("Management", "chief-of-staff management exception", words="chief of staff"),
    Rule("Executive", "executive title", words="chief|cto|ciso|cio|ceo"),
    Rule("Management", "leadership title", words="vp|vice president|head of|director"),
    Rule(
        "People/Recruiting",
        "people/recruiting title",
        words="recruiter|talent acquisition|sourcer|people partner|hr|human resources",
    ),
    Rule("Product", "product title", words="product manager|product owner|product lead"),
    Rule(
        "Program",
        "program title",
        words="tpm|program manager|program analyst|program coordinator|project manager"
        "|project analyst",
    ),
    Rule(
        "Management",
        "engineering management title",
        words="engineering manager|development manager|manager, engineering",
    ),
    Rule(
        "Developer Relations",
        "developer-relations title",
        words="developer relations|devrel|developer advocate|cloud advocate|developer experience",
    ),
    Rule(
        "Solutions/Sales Engineering",
        "customer-facing technical title",
        words="solutions? engineer|sales engineer|pre-?sales|solutions? architect"
        "|customer engineer|forward deployed engineer|forward deploy engineer|field engineer",
    ),
    Rule(
        "Data Operations/Annotation",
        "data operations/annotation title",
        words="data collector|data collection|data ambassador|ai trainer|ai training"
        "|model evaluation|content quality|survey participants",
        stems="data annotat|data label",
    ),
    Rule(
        "QA/Test",
        "quality/test title",
        words="qa|quality assurance|quality engineer|test engineer|software automation engineer"
        "|software test|sdet|validation engineer|verification engineer|automation/test"
        "|test automation",
    ),
    Rule(
        "Security",
        "security title",
        words="cybersecurity|cyber security|security engineer|application security"
        "|product security|data protection|information security|cloud security"
        "|network security|security operations|vulnerability|forensic analyst",
    ),
    Rule(
        "Hardware/Embedded",
        "hardware/embedded title",
        words="firmware|embedded|electrical|fpga|silicon|hardware|gpu kernel|cuda|chip"
        "|emulation engineer|system memory",
        inner=" asic",
    ),
    Rule(
        "Robotics/Autonomy",
        "robotics/autonomy title",
        words="robotics|robot|autonomous|autonomy|self-driving|perception|vehicle"
        "|driving system",
    ),
    Rule(
        "AI/ML",
        "ai/ml title",
        words="machine learning|ml engineer|ai engineer|artificial intelligence|mlops"
        "|ml[- ]ops|deep learning|computer vision|nlp|llm|genai|generative ai|agentic|ai/ml"
        "|ai ops|ai compiler|ai applications engineer|ai agent engineer|ai applied .*engineer"
        "|ai automation|ai development|ai infrastructure|ai innovation|ai production|ai data"
        "|scientific ai|ml product engineer|applied scientist",
    ),
    Rule(
        "Data Science",
        "data science title",
        words="data scientist|data science|decision scientist",
    ),
    Rule("Research", "research/scientist title", words="research engineer|scientist"),
    Rule(
        "Data Engineering",
        "data engineering title",
        words="data engineer|data engineering|analytics engineer|etl|data platform"
        "|data solutions engineer|data governance|data modeler|data scraping"
        "|database engineer|data operations|data and asset management|data & identity"
        "|microsoft fabric|informatica|data quality",
        stems="data infra",
    ),
    Rule(
        "Analytics/BI",
        "analytics/bi title",
        words="data analyst|analyst/engineer|data insights|customer insights"
        "|financial analyst|metadata analyst|business intelligence|enterprise intelligence"
        "|bi analyst|bi engineer|reporting analyst|insights analyst|static data|analytics"
        "|research analyst",
    ),
    Rule(
        "DevOps/SRE",
        "devops/sre title",
        words="devops|site reliability|sre|reliability engineering|reliability engineer"
        "|dev ops",
    ),
    Rule(
        "Infrastructure/Platform",
        "infrastructure/platform title",
        words="platform engineer|platformization|cloud engineer|engineer cloud services"
        "|cloud automation|cloud infrastructure|aws engineer|azure build engineer"
        "|infrastructure engineer|systems engineer|system engineer|systems analysis engineer"
        "|system design engineer|network engineer|network operations engineer"
        "|network ip engineer|network automation|fiber connectivity engineer"
        "|endpoint engineer|vm engineer|software defined storage|hil platform"
        "|power engineer|systems architect|system architect|site infrastructure|data center",
    ),
    Rule(
        "IT/Support",
        "it/support title",
        words="support engineer|technical support|software support|network support"
        "|contact center engineer|software installation engineer|help desk|it support"
        "|desktop support|systems administrator|system administrator|sysadmin",
    ),
    Rule("Design", "design title", words="designer|ux|ui|user experience"),
    Rule("Product", "product analyst/expert title", words="product analyst|product expert"),
    Rule(
        "Customer Success/Implementation",
        "customer implementation/success title",
        words="customer success|implementation|solutions consultant|technical consultant"
        "|client advisor|customer service|customer support/applications engineer",
    ),
    Rule(
        "Marketing/Growth",
        "marketing/growth title",
        words="marketing|growth|demand generation|go[- ]to[- ]market",
    ),
    Rule(
        "Healthcare/Clinical",
        "healthcare/clinical title",
        words="clinician|clinical|behavior interventionist|pharmacy technician|nurse|patient"
        "|therapist|medical",
    ),
    Rule(
        "Retail/Service",
        "retail/service title",
        words="cashier|car washer|club attendant|culinary|retail|sales associate"
        "|counter sales|store|host",
    ),
    Rule(
        "Finance/Investment",
        "finance/investment title",
        words="investor|investment|commercial analyst|procurement|buyer|consignment",
    ),
    Rule(
        "Facilities/Field Ops",
        "facilities/field operations title",
        words="camera operator|camera support technician|transportation planner|construction"
        "|union relief engineer|mechanical engineer|field technician",
    ),
    Rule(
        "Business/Ops",
        "business/operations title",
        words="business operations|business systems|operations analyst|operations associate"
        "|business analyst|business management analyst|strategy|contract management"
        "|asset management analyst|transaction analytics",
    ),
    Rule(
        "Admin/Operations",
        "admin/operations title",
        words="office assistant|coordinator|surveys|survey|posted job description",
    ),
    Rule(
        "Education/Training",
        "education/training title",
        words="education|teacher|tutor|instructor|trainer|training",
    ),
    Rule(
        "SWE",
        "software engineering title",
        words="engineer software|software development engineer|software dev engineer"
        "|software dev\\.? engineer|software engin+er|software design engineer"
        "|software integration|software architect|engineer.*software"
        "|member of technical staff|chromium|cef|application engineer"
        "|application .*engineer|graphics programmer|programmer|backend|frontend|front-end"
        "|front end|back-end|back end|full stack|fullstack|full-stack|mobile engineer"
        "|ios engineer|android engineer|javascript engineer|react\\.js|developer"
        "|founding engineer|creator services|rust software",
        stems="software engineer",
        outer="c\\+\\+",
    ),
    Rule("Management", "generic management title", words="manager|lead"),
)
DEFAULT_ROLE = ("Other", "no deterministic role-family match")

# The closed sets of labels.
ROLE_FAMILIES = (
    "SWE", "AI/ML", "Data Science", "Data Engineering", "Analytics/BI",
    "Data Operations/Annotation", "DevOps/SRE", "Infrastructure/Platform", "Security", "QA/Test",
    "Hardware/Embedded", "Robotics/Autonomy", "Research", "Product", "Program", "Design",
    "Management", "Executive", "Solutions/Sales Engineering", "Developer Relations",
    "IT/Support", "Customer Success/Implementation", "Business/Ops", "Admin/Operations",
    "Marketing/Growth", "People/Recruiting", "Education/Training", "Healthcare/Clinical",
    "Retail/Service", "Finance/Investment", "Facilities/Field Ops", "Other",
)
SENIORITIES = ("Intern", "Entry", "Mid", "Senior", "Staff+", "Manager", "Director+", "Executive")
TRACKS = ("IC", "Manager", "Executive", "Non-technical")
WORKPLACES = ("Remote", "Hybrid", "On-site", "Unknown")
SEVERITIES = ("info", "warning", "error")

# Seniority rules in order. The executive family comes between the two lists.
SENIORITY_FIRST = (
    Rule("Director+", "chief-of-staff leadership title", words="chief of staff"),
    Rule("Intern", "intern title", words="intern|internship"),
    Rule(
        "Entry",
        "entry title",
        words="new grad|new college grad|entry level|early career|junior|jr",
    ),
)
SENIORITY_EXECUTIVE = ("Executive", "executive role family")
SENIORITY_THEN = (
    Rule("Director+", "director-plus title", words="vp|vice president|director|head of"),
    Rule("Staff+", "staff-plus title", words="distinguished|principal|staff"),
    Rule("Senior", "senior title", words="senior|sr|lead"),
    Rule("Manager", "manager title", words="manager"),
)
DEFAULT_SENIORITY = ("Mid", "default mid-level")

# Track membership.
MANAGER_FAMILIES = ("Management", "Product", "Program")
MANAGER_LEVELS = ("Manager", "Director+")
NON_TECHNICAL_FAMILIES = (
    "People/Recruiting", "Business/Ops", "Admin/Operations", "Marketing/Growth",
    "Customer Success/Implementation", "Education/Training", "Healthcare/Clinical",
    "Retail/Service", "Finance/Investment", "Facilities/Field Ops",
)
NON_TECHNICAL_WORDS = "recruiter|talent acquisition|marketing|customer success"
NON_TECHNICAL_BY_WORD = ("Design", "Other")

# Workplace rules in order.
WORKPLACE_RULES = (
    Rule("Hybrid", "hybrid signal", words="hybrid"),
    Rule("Remote", "remote signal", words="remote|work from home"),
    Rule("On-site", "on-site signal", words="on-site|onsite|in office"),
)
DEFAULT_WORKPLACE = ("Unknown", "no workplace signal")

# Confidence of a classification, and what each recognised label adds.
CONFIDENCE_BASE = 0.62
CONFIDENCE_ROLE = 0.18
CONFIDENCE_SENIORITY = 0.08
CONFIDENCE_WORKPLACE = 0.04
CONFIDENCE_CAP = 0.95

# Macro areas of the market report.
MACRO_AREAS = {
    "Engineering / Infrastructure": (
        "SWE", "Infrastructure/Platform", "DevOps/SRE", "Security", "QA/Test",
        "Hardware/Embedded", "Robotics/Autonomy",
    ),
    "Product / Program / Leadership": ("Product", "Program", "Management", "Executive"),
    "AI / Data / Research": (
        "AI/ML", "Data Science", "Data Engineering", "Analytics/BI",
        "Data Operations/Annotation", "Research",
    ),
    "Customer-facing technical": (
        "Solutions/Sales Engineering", "Developer Relations",
    ),
    "Residual Other / Design": ("Other", "Design"),
}

# Terms of the skills-and-platform signals, each a set of whole words.
SIGNALS = {
    "AI/ML/LLM explicit": "ai|ml|llm|artificial intelligence|machine learning",
    "Python": "python",
    "Security": "security",
    "AWS": "aws",
    "SQL": "sql",
    "JavaScript/TypeScript/React/Node": "javascript|typescript|react|node",
    "Azure": "azure",
    "Kubernetes": "kubernetes",
    "GCP": "gcp",
    "Java": "java",
}

JUNIOR = ("Entry", "Intern")
AI_DATA_RESEARCH = ("AI/ML", "Data Science", "Data Engineering", "Research")

# --- Older substring taxonomies -------------------------------------------------------

# Role types by substring.
LEGACY_ROLE_TYPES = (
    PartRule("Engineering Manager", ("manager",), but=("program", "product")),
    PartRule("ML/AI Engineer", ("machine learning", "ml engineer", "ai engineer")),
    PartRule("Data Scientist", ("data scientist",)),
    PartRule("Data Engineer", ("data engineer",)),
    PartRule("DevOps/SRE", ("devops", "site reliability", "sre")),
    PartRule("Platform Engineer", ("platform engineer",)),
    PartRule("Backend Engineer", ("backend", "back-end")),
    PartRule("Frontend Engineer", ("frontend", "front-end")),
    PartRule("Full Stack Engineer", ("full stack", "fullstack")),
    PartRule("Security Engineer", ("security engineer",)),
    PartRule("Cloud Engineer", ("cloud engineer",)),
    PartRule("Solutions Architect", ("solutions architect", "solution architect")),
    PartRule("Software Engineer", ("software engineer",)),
)
# Seniority levels by substring.
LEGACY_SENIORITY = (
    PartRule("Intern", ("intern",)),
    PartRule("C-Suite", ("chief", "cto", "cfo", "coo", "ceo", "cpo")),
    PartRule("VP", ("vp", "vice president")),
    PartRule("Director", ("director",)),
    PartRule("Head", ("head of",)),
    PartRule("Principal", ("principal", "distinguished")),
    PartRule("Staff", ("staff",)),
    PartRule("Senior", ("senior", "sr.", "sr ")),
    PartRule("Lead", ("lead",), but=("leader",)),
    PartRule("Junior", ("junior", "jr.", "jr ", "entry level", "new grad", "early career")),
    PartRule("Manager", ("manager",)),
    PartRule("Mid-Level", ("engineer", "developer", "scientist", "analyst", "architect")),
)
# The short category list by substring.
LEGACY_CATEGORIES = (
    PartRule("AI/ML Engineering", ("machine learning", "ml engineer", "ai engineer")),
    PartRule("Data Science", ("data scientist", "data science")),
    PartRule("Data Engineering", ("data engineer", "etl developer")),
    PartRule("DevOps/Infrastructure", ("devops", "site reliability", "sre")),
    PartRule("Security", ("security engineer", "cybersecurity")),
    PartRule("Frontend", ("frontend", "front-end")),
    PartRule("Backend", ("backend", "back-end")),
    PartRule("Full Stack", ("full stack", "fullstack")),
    PartRule("Software Engineering (General)", ("software engineer", "software developer")),
)
# The long category list by substring.
LEGACY_CATEGORIES_LONG = (
    PartRule("C-Suite", ("chief", "cto", "cfo", "coo", "cpo", "ciso", "ceo")),
    PartRule("Vice President", ("vp", "vice president")),
    PartRule("Head of Department", ("head of",)),
    PartRule("Director", ("director of",)),
    PartRule(
        "Engineering Management",
        ("engineering manager", "tech lead", "technical lead", "team lead", "development manager"),
    ),
    PartRule("Management (Other)", ("manager",)),
    PartRule("Product Management", ("product owner",)),
    PartRule(
        "AI/ML Engineering",
        ("machine learning", "ml engineer", "ai engineer", "artificial intelligence", "mlops"),
    ),
    PartRule("Data Science", ("data scientist",)),
    PartRule("Data Engineering", ("data engineer", "etl developer", "data pipeline")),
    PartRule("Data Analytics/BI", ("data analyst", "business analyst", "analytics")),
    PartRule(
        "DevOps/Infrastructure", ("devops", "site reliability", "sre", "platform engineer")
    ),
    PartRule("Security", ("security engineer", "cybersecurity")),
    PartRule("Frontend", ("frontend", "front-end", "react developer")),
    PartRule("Backend", ("backend", "back-end")),
    PartRule("Full Stack", ("full stack", "fullstack")),
    PartRule("Mobile", ("mobile", "ios", "android")),
    PartRule("QA/Testing", ("qa", "quality assurance", "test engineer")),
    PartRule("Technical Architect", ("architect",)),
    PartRule("Solutions Engineering", ("solutions engineer",)),
    PartRule("Design/UX", ("designer", "ux", "ui")),
    PartRule("Life Sciences", ("bio", "clinical", "pharma", "chemistry"), also=("scientist",)),
    PartRule("Life Sciences", ("bio", "clinical", "pharma", "chemistry"), also=("research",)),
    PartRule("Research", ("scientist", "research")),
    PartRule("Software Engineering", ("software developer", "engineer")),
    PartRule("IT Support", ("it support", "help desk", "it specialist")),
    PartRule("Operations", ("operations",)),
    PartRule(
        "Non-Technical",
        ("recruiter", "talent", "sales", "customer success", "marketing", "content",
         "administrative"),
    ),
)
# The six-level seniority list by substring.
LEGACY_SENIORITY_SHORT = (
    PartRule("Intern", ("intern",)),
    PartRule("Junior", ("junior", "jr.", "entry level", "new grad", "associate")),
    PartRule("Senior", ("senior", "sr.", "lead")),
    PartRule("Staff+", ("staff", "principal", "distinguished")),
    PartRule("Management", ("manager", "director", "vp", "head", "chief")),
)
# Groups over the long category list and over the seniority levels.
CATEGORY_GROUPS = {
    "Leadership": (
        "C-Suite", "Vice President", "Director", "Head of Department", "Engineering Management",
        "Management (Other)",
    ),
    "IC Engineering": (
        "Software Engineering", "AI/ML Engineering", "Frontend", "Backend", "Full Stack",
        "DevOps/Infrastructure", "Security", "Mobile",
    ),
    "Data Roles": ("Data Science", "Data Engineering", "Data Analytics/BI"),
    "Product/Program": (
        "Product Management", "Technical Program Management", "Project Management",
    ),
    "Other Technical": (
        "QA/Testing", "Technical Architect", "Solutions Engineering", "Design/UX",
    ),
    "Non-Technical": ("Non-Technical", "IT Support", "Operations", "Life Sciences"),
}
SENIORITY_GROUPS = {
    "Leadership": ("C-Suite", "VP", "Director", "Head", "Manager"),
    "Senior IC": ("Principal", "Staff", "Senior", "Lead"),
    "Junior IC": ("Junior", "Intern"),
    "Mid-Level IC": ("Mid-Level",),
}
LEGACY_JUNIOR = ("Junior", "Intern")
