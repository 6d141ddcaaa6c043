"""Titles labelled by hand, grouped by (family, seniority, track). Written without the rule tables: each
family has plain cases, neighbours that only look like it, and titles that two families claim."""

GROUPS = {
    ("Executive", "Executive", "Executive"): "Chief Technology Officer; Chief Risk Officer; CTO; CIO, Europe; CEO; CISO; "
    "Deputy CTO; Senior Chief Engineer; Chief Product Manager",
    ("Executive", "Intern", "Executive"): "CTO Office Intern",
    ("Executive", "Entry", "Executive"): "Junior CIO",
    ("Management", "Director+", "Manager"): "Chief of Staff; Chief of Staff to the CTO; VP, Data; Vice President Engineering; "
    "Head of Security; Director of Software Engineering; Recruiting Director; Director, Machine Learning; Principal Director",
    ("Management", "Manager", "Manager"): "Engineering Manager, Ads; Manager, Engineering; Software Development Manager; "
    "Account Manager; Case Manager",
    ("Management", "Senior", "Manager"): "Team Lead; Shift Lead; Senior Engineering Manager; Lead, Partnerships",
    ("People/Recruiting", "Mid", "Non-technical"): "Technical Recruiter; Talent Acquisition Partner; Sourcer; HR Generalist; "
    "Human Resources Associate; People Partner",
    ("People/Recruiting", "Senior", "Non-technical"): "Lead Recruiter; Senior Sourcer",
    ("People/Recruiting", "Manager", "Manager"): "HR Manager; Talent Acquisition Manager",
    ("Product", "Manager", "Manager"): "Product Manager, Search; AI Product Manager; Data Product Manager",
    ("Product", "Senior", "Manager"): "Senior Product Owner; Product Lead; Lead Product Manager; Sr Product Manager",
    ("Product", "Staff+", "Manager"): "Principal Product Manager",
    ("Product", "Intern", "Manager"): "Product Manager Intern; Product Owner Internship",
    ("Product", "Mid", "Manager"): "Product Expert; Product Owner, Data Platform; Product Analyst, Ads",
    ("Program", "Manager", "Manager"): "Program Manager; Technical Program Manager; Project Manager, Cloud; Security Program Manager",
    ("Program", "Mid", "Manager"): "TPM; Program Analyst; Program Coordinator; Project Analyst",
    ("Program", "Senior", "Manager"): "Senior TPM; Lead Program Manager",
    ("Developer Relations", "Mid", "IC"): "DevRel Engineer; Cloud Advocate; Developer Experience Engineer; Developer Relations Engineer",
    ("Developer Relations", "Senior", "IC"): "Senior Developer Advocate",
    ("Solutions/Sales Engineering", "Mid", "IC"): "Solutions Engineer; Solution Engineer; Pre-Sales Engineer; Customer Engineer; "
    "Forward Deployed Engineer; Field Engineer; Solutions Architect",
    ("Solutions/Sales Engineering", "Staff+", "IC"): "Principal Solutions Architect; Staff Field Engineer",
    ("Data Operations/Annotation", "Mid", "IC"): "Data Collector; Data Collection Associate; AI Trainer; AI Training Specialist; "
    "Model Evaluation Analyst; Content Quality Reviewer; Data Annotation Analyst; Data Labeler; Survey Participants Wanted",
    ("QA/Test", "Mid", "IC"): "QA Automation Engineer; Quality Assurance Analyst; Test Engineer; SDET; Validation Engineer; "
    "Verification Engineer; Quality Engineer; Software Automation Engineer",
    ("QA/Test", "Senior", "IC"): "Senior QA Engineer; Lead Test Engineer",
    ("Security", "Mid", "IC"): "Security Engineer; Cyber Security Analyst; Product Security Engineer; Data Protection Officer; "
    "Cloud Security Engineer; Network Security Analyst; Vulnerability Researcher; Information Security Analyst; Forensic Analyst",
    ("Security", "Senior", "IC"): "Senior Security Engineer",
    ("Hardware/Embedded", "Mid", "IC"): "Firmware Engineer; Embedded Software Engineer; FPGA Designer; Electrical Engineer; "
    "Silicon Engineer; Hardware Engineer; CUDA Programmer; Digital ASIC Engineer; Chip Architect",
    ("Robotics/Autonomy", "Mid", "IC"): "Robot Technician; Autonomous Driving Engineer; Autonomy Engineer; Perception Engineer; "
    "Vehicle Engineer; Self-Driving Engineer",
    ("AI/ML", "Mid", "IC"): "Machine Learning Engineer; ML Engineer; AI Engineer; Deep Learning Researcher; NLP Engineer; LLM Engineer; "
    "GenAI Developer; ML-Ops Engineer; Applied Scientist; AI/ML Engineer; Agentic Systems Builder; Artificial Intelligence Specialist; "
    "AI Infrastructure Engineer; AI Data Engineer",
    ("AI/ML", "Senior", "IC"): "Senior Machine Learning Engineer; Lead AI Engineer",
    ("AI/ML", "Staff+", "IC"): "Principal Applied Scientist; Staff ML Engineer",
    ("AI/ML", "Intern", "IC"): "Machine Learning Intern",
    ("Data Science", "Mid", "IC"): "Data Scientist, Growth; Decision Scientist; Data Science Consultant",
    ("Data Science", "Senior", "IC"): "Senior Data Scientist; Sr Data Scientist",
    ("Data Science", "Manager", "Manager"): "Data Science Manager",
    ("Research", "Mid", "IC"): "Research Engineer; Scientist II; Research Scientist; Computational Scientist",
    ("Research", "Senior", "IC"): "Senior Research Scientist",
    ("Data Engineering", "Mid", "IC"): "Data Engineer; Data Engineering Consultant; Analytics Engineer, Ads; ETL Developer; "
    "Data Platform Engineer; Data Governance Analyst; Database Engineer; Data Quality Analyst; Informatica Developer; "
    "Data Infrastructure Engineer; Data Modeler",
    ("Data Engineering", "Senior", "IC"): "Senior Data Engineer; Lead Data Engineer",
    ("Analytics/BI", "Mid", "IC"): "Data Analyst, Pricing; BI Analyst; BI Engineer; Business Intelligence Developer; Reporting Analyst; "
    "Insights Analyst; Financial Analyst; Research Analyst; Product Analytics Specialist",
    ("Analytics/BI", "Entry", "IC"): "Junior Data Analyst; Entry Level Data Analyst",
    ("Analytics/BI", "Senior", "IC"): "Senior Financial Analyst",
    ("DevOps/SRE", "Mid", "IC"): "DevOps Engineer; SRE; Reliability Engineer; Dev Ops Engineer; Reliability Engineering Specialist",
    ("DevOps/SRE", "Senior", "IC"): "Senior SRE",
    ("Infrastructure/Platform", "Mid", "IC"): "Cloud Engineer, Azure; Network Engineer; Systems Engineer; System Architect; "
    "Data Center Technician; Infrastructure Engineer; AWS Engineer; Cloud Automation Specialist; VM Engineer; Application Platform Engineer",
    ("Infrastructure/Platform", "Staff+", "IC"): "Staff Platform Engineer",
    ("IT/Support", "Mid", "IC"): "Support Engineer; Technical Support Specialist; IT Support Analyst; Desktop Support Technician; "
    "Systems Administrator; Sysadmin; Help Desk Analyst",
    ("Design", "Mid", "IC"): "Product Designer; UX Writer; UI Artist; User Experience Specialist; Interior Designer",
    ("Design", "Mid", "Non-technical"): "Marketing Designer",
    ("Customer Success/Implementation", "Mid", "Non-technical"): "Customer Success Specialist; Implementation Specialist; "
    "Solutions Consultant; Technical Consultant; Client Advisor; Customer Service Agent",
    ("Customer Success/Implementation", "Manager", "Manager"): "Customer Success Manager; Implementation Manager",
    ("Marketing/Growth", "Mid", "Non-technical"): "Marketing Associate; Growth Hacker; Demand Generation Specialist; Go-to-Market Strategist",
    ("Marketing/Growth", "Manager", "Manager"): "Marketing Manager; Growth Manager",
    ("Healthcare/Clinical", "Mid", "Non-technical"): "Nurse Practitioner; Clinical Associate; Physical Therapist; Medical Assistant; "
    "Pharmacy Technician; Patient Advocate; Behavior Interventionist",
    ("Retail/Service", "Mid", "Non-technical"): "Cashier; Car Washer; Sales Associate; Store Associate; Restaurant Host; "
    "Culinary Assistant; Retail Associate",
    ("Retail/Service", "Manager", "Manager"): "Store Manager",
    ("Finance/Investment", "Mid", "Non-technical"): "Investment Associate; Commercial Analyst; Procurement Associate; Buyer; "
    "Investor Relations Associate",
    ("Facilities/Field Ops", "Mid", "Non-technical"): "Construction Planner; Mechanical Engineer; Field Technician; Camera Operator; "
    "Transportation Planner",
    ("Business/Ops", "Mid", "Non-technical"): "Business Operations Associate; Operations Analyst; Strategy Associate; "
    "Business Systems Analyst; Operations Associate; Contract Management Specialist",
    ("Admin/Operations", "Mid", "Non-technical"): "Coordinator; Office Assistant II; Survey Taker; Events Coordinator",
    ("Education/Training", "Mid", "Non-technical"): "Teacher; Math Tutor, Online; Yoga Instructor; Fitness Trainer; "
    "Education Consultant; Training Specialist",
    ("SWE", "Mid", "IC"): "Software Engineer; Backend Engineer; Front-End Engineer; Full Stack Engineer; Fullstack Developer; "
    "Android Engineer; React.js Engineer; Java Developer; Programmer; Software Architect; Application Engineer; Founding Engineer; "
    "Engineer, Software; Mobile Engineer",
    ("SWE", "Staff+", "IC"): "Member of Technical Staff; Staff Software Engineer; Principal Backend Engineer; Distinguished Engineer, Software",
    ("SWE", "Senior", "IC"): "Senior Software Engineer; Lead Developer; Sr Full-Stack Engineer; Senior iOS Engineer",
    ("SWE", "Entry", "IC"): "Junior Developer; Jr Backend Engineer; New Grad Software Engineer; Early Career Developer; "
    "New College Grad Programmer",
    ("SWE", "Intern", "IC"): "Software Engineering Intern; Developer Intern; Backend Internship",
    ("Other", "Mid", "IC"): "Directory Engineer; MVP Engineer; Internet Engineer; Astronaut; Pilot; Chemist; Accountant; Lawyer; Leader; "
    "Chiefly Editor; Suite Attendant; Analyst; Engineer; Consultant; Mechanic; Producer; Geologist; Storey Builder; Hostel Keeper",
    ("Other", "Staff+", "IC"): "Principal Engineer; Distinguished Engineer; Staff Accountant",
    ("Other", "Senior", "IC"): "Senior Accountant; Sr Chemist",
    ("Other", "Entry", "IC"): "Junior Accountant; New Grad Engineer",
    ("Other", "Intern", "IC"): "Legal Intern; Engineering Intern",
}
TITLES = [(title, *labels) for labels, titles in GROUPS.items() for title in titles.split("; ")]
