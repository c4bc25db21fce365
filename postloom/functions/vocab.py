"""Word lists and patterns that define results.

Fixed values throughout: these lists decide what matches, so they are stated
as they are.  Every list is a parameter default of the function that uses it.
"""

from __future__ import annotations

import re

# Terms of the loose title filter.
LOOSE_TITLE_TERMS = (
    "designer; design; ux; ui; visual; product design; graphic; artist; illustrator; animator; motion; 3d; videographer; photographer; editor; producer; writer; "
    "copywriter; journalist; editorial; music; audio; sound; composer; creative; brand; content; campaign; fashion; stylist; apparel; character artist; environment artist"
).split("; ")
# Terms of the strict title filter, for and against.
STRICT_TITLE_TERMS = (
    "design; designer; ux; ui; product design; graphic; visual; art director; creative director; brand; branding; content; copywriter; writer; editor; motion; animation; "
    "animator; illustrator; video; videographer; photographer; stylist; fashion; 3d; vfx; game artist; sound; music"
).split("; ")
OTHER_TRADE_TERMS = (
    "account executive; accounts payable; bookkeeper; tax; auditor; compliance; legal counsel; paralegal; salesforce admin; warehouse; driver; recruiter; "
    "talent acquisition; customer support; customer success; business analyst; financial analyst"
).split("; ")
SAVING_TERMS = "design; creative; content; brand; art".split("; ")
# Terms of the text score.
SKILL_TERMS = (
    "figma; adobe creative suite; after effects; premiere pro; photoshop; illustrator; indesign; blender; cinema 4d; maya; storyboard; typography; color grading; "
    "interaction design; design system; copywriting; brand strategy; visual identity; motion graphics"
).split("; ")
GENERIC_TERMS = "creative; design; visual; brand; content".split("; ")
AGAINST_TERMS = "software engineer; backend; frontend; devops; accountant; finance; legal".split("; ")
# Words that name a role in a title.
ROLE_TERMS = (
    "designer; design; artist; writer; editor; producer; engineer; developer; manager; director; specialist; scientist; architect; analyst; intern; coordinator"
).split("; ")
# Titles that are page furniture, as whole titles or as beginnings.
NOISE_TITLE = (
    r"^(?:(?:skip to|learn more|read more)(?:[^A-Za-z0-9_]|$)|(?:home|about|privacy|cookie|terms|newsroom|careers?|search jobs?|view all jobs?|view all teams?"
    r"|join our talent community|see next steps|explore university opportunities)$)"
)
SKIP_TITLES = (
    "skip to main content; skip to content; home; careers; career; apply now; search jobs; search job; view all jobs; view all; current openings; list of jobs; join our team"
).split("; ")
# Titles of collections, agencies, portfolios and news.
SKIP_PATTERNS = (
    r"^jobs\s+in\s+(?:design|editorial|creative|ux|ui|graphic|motion|brand|content)(?:\s+design)?\s*$",
    r"^(?:design|editorial\s+design|creative|ux\s*/?\s*ui|graphic\s+design)\s+jobs\s*$",
    r"(?:web\s+design\s+agency|startup\s+web\s+design\s+agency|design\s+agency|creative\s+agency|branding\s+agency)\s*$",
    r"(?:^|[^A-Za-z0-9_])(?:web\s+designer|logo\s+designer|graphic\s+designer)\s*,\s*[A-Za-z0-9_\s]+\s+freelance\s*$",
    r"design\s+awards?\s+[0-9]{4}|shortlisted\s+for|another\s+win\s+for|what\s+.*\s+taught\s+me|insights?(?:[^A-Za-z0-9_]|$)|newsletter(?:[^A-Za-z0-9_]|$)",
)
LISTING_PATHS = "/careers; /career; /jobs; /job; /about/careers; /en/work-with-us/jobs; /careers/open-positions".split("; ")
BREADCRUMB = r"""^['"]?(?:home\s*>\s*)?(?:careers?|jobs?)(?:\s*>\s*[^'"]*)?['"]?\s*"""
ID_PARAM = r"gh_jid|jobid|job_id|requisition|req|reqid|opening|openingid|posting|postingid|position|positionid|vacancy|vacancyid|id"
TRACKING_PARAM = r"utm_.*|ref|source|src|trk|tracking"
KNOWN_HOSTS = r"greenhouse\.io|lever\.co|smartrecruiters\.com|myworkdayjobs\.com|icims\.com|amazon\.jobs|ashbyhq\.com"
# Titles that stand for a broken or general page.
INVALID_TITLES = (
    r"^page not found$", r"^404$", r"^error$", r"^select which cookies", r"^cookie", r"^current openings at", r"^careers at", r"^open roles$", r"^design team$",
    r"^jobs in ", r"^opportunities by ", r"^great website design",
)
SPECIFIC_URL = r"/(?:job|position|career|opening|role|vacancy)s?/|/careers/[a-z0-9]+-[a-z0-9]|/jobs/[0-9]+|[?&]gh_jid="
# First path segments that name no tenant.
JUNK_SLUGS = (
    "embed blog jobs careers api static assets js css img images fonts favicon.ico robots.txt sitemap.xml privacy terms login auth signup oauth callback help support faq "
    "about contact home index healthcheck health .well-known cdn-cgi"
).split()
# Systems in the order in which they are recognised, with the signs of each.
SYSTEM_SIGNS = (
    ("greenhouse", "greenhouse.io"),
    ("workday", "myworkdayjobs.com; /wday/cxs/; workday"),
    ("lever", "lever.co"),
    ("smartrecruiters", "smartrecruiters.com"),
    ("icims", "icims"),
    ("ashby", "ashbyhq.com; posting-api/job-board"),
    ("phenom", 'phenompeople.com; careerconnectresources; /widgets; "refnum"'),
    ("amazon", 'amazon.jobs; search.json?offset; "job_path"'),
    ("workable", "apply.workable.com; jobs.workable.com; workable.com/api/accounts; workable.com/j/"),
)
# Terms that become keywords where they occur, and values that never do.
KEYWORD_TERMS = "design; creative; brand; content; visual; motion; animation; ux; ui; product design; graphic design; art direction; copywriting; video; music; fashion".split("; ")
KEYWORD_BLOCKLIST = (
    "other; not specified; other / not specified; other/not specified; n/a; na; none; unspecified; unknown; general; miscellaneous; misc; various; all; any; tbd; "
    "see description; see below; not applicable; other category"
).split("; ")
# Spellings of job types beside the four values themselves.
JOB_TYPES = ("GIG", "FULLTIME", "PARTTIME", "FREELANCE")
JOB_TYPE_MAP = {
    "INTERNSHIP": "GIG", "FIXEDTERM": "GIG", "CONTRACT": "GIG", "TEMPORARY": "GIG", "FULL-TIME": "FULLTIME", "FULL_TIME": "FULLTIME", "FULL TIME": "FULLTIME",
    "PART-TIME": "PARTTIME", "PART_TIME": "PARTTIME", "PART TIME": "PARTTIME", "FREELANCER": "FREELANCE",
}
# Country codes, states and provinces of the location reader.
COUNTRIES = dict(
    pair.split("=")
    for pair in (
        "US=United States;UK=United Kingdom;GB=United Kingdom;CA=Canada;AU=Australia;NZ=New Zealand;IN=India;SG=Singapore;AE=United Arab Emirates;UAE=United Arab Emirates;DE=Germany;"
        "FR=France;ES=Spain;IT=Italy;NL=Netherlands;BE=Belgium;PT=Portugal;CH=Switzerland;AT=Austria;IE=Ireland;SE=Sweden;NO=Norway;FI=Finland;DK=Denmark;PL=Poland;CZ=Czech Republic;"
        "HU=Hungary;RO=Romania;GR=Greece;TR=Turkey;IL=Israel;JP=Japan;KR=South Korea;CN=China;HK=Hong Kong;TW=Taiwan;TH=Thailand;VN=Vietnam;MY=Malaysia;ID=Indonesia;PH=Philippines;"
        "BR=Brazil;MX=Mexico;AR=Argentina;CL=Chile;CO=Colombia;PE=Peru;ZA=South Africa;NG=Nigeria;EG=Egypt"
    ).split(";")
)
US_STATES = "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC".split()
CA_PROVINCES = "AB BC MB NB NL NS NT NU ON PE QC SK YT".split()
REMOTE_REGIONS = "global worldwide emea apac latam europe asia usa us uk canada india".split()
LOCATION_NOISE = (
    "responsibilit; qualification; benefit; apply for this job; job alert; equal opportunity; privacy notice; what you'll; you will; our team; interview; voluntary self; "
    "screening question; portfolio; resume; autofill"
).split("; ")
# Mailbox names that belong to no hiring person.
GENERIC_MAILBOX = r"no-?reply|donotreply|privacy|gdpr|legal|unsubscribe|support|info|hello|contact|admin|postmaster"
# Skills and the words by which they are recognised, in order.
SKILL_TAXONOMY = {
    name: words.split(", ")
    for name, words in (
        line.split(": ")
        for line in """figma: figma
sketch: sketch app, sketch
adobe_creative_suite: adobe creative suite, creative suite, adobe cc, adobe suite
photoshop: photoshop, adobe photoshop
illustrator: illustrator, adobe illustrator
indesign: indesign, adobe indesign
after_effects: after effects, adobe after effects
premiere_pro: premiere pro, adobe premiere
davinci_resolve: davinci resolve
final_cut_pro: final cut, final cut pro, fcp
blender: blender
cinema4d: cinema 4d, c4d
maya: maya, autodesk maya
houdini: houdini
zbrush: zbrush
unity: unity
unreal_engine: unreal, unreal engine
protopie: protopie
framer: framer
webflow: webflow
typography: typography, type design
storyboarding: storyboard, storyboarding
motion_graphics: motion graphics, motion design
video_editing: video editing, video production, post-production
color_grading: color grading
ux_research: ux research, user research, qualitative research
wireframing: wireframing, wireframe
prototyping: prototyping, prototype
design_systems: design systems, design tokens
interaction_design: interaction design, ixd
information_architecture: information architecture
branding: branding, brand identity, visual identity
copywriting: copywriting, copy writer
content_strategy: content strategy, editorial strategy
social_media: social media, social content
seo: seo, search engine optimization
email_marketing: email marketing
art_direction: art direction, art director
creative_direction: creative direction, creative director
sound_design: sound design, audio editing, sound editing
music_production: music production, composition
fashion_styling: fashion styling, styling
pattern_making: pattern making, pattern cutting
technical_design: technical design, tech pack""".splitlines()
    )
}
SKILL_STOP_WORDS = frozenset("and or with in of to the a an experience proficiency knowledge ability skills skill".split())
SENTENCE_WORDS = frozenset("the to they that this their them need deliver enable companies tracks".split())
# The patterns of the score tiers, best tier first; ``\\b`` is the end of an ASCII word.
TIERS = {
    10: r"""
        \billustrat ; \banimator\b ; \banimation\b ; \bart director\b ; \bgraphic design ; \bvisual design ; \bux design ; \bui design ; \bui/ux\b ; \bux/ui\b
        \bvideo edit ; \bmotion design ; \bmotion graphic ; \bgame design ; \bcharacter design ; \btypograph ; \bfashion design ; \bjewelry design
        \bindustrial design ; \bproduct design ; \binteraction design ; \bexperience design ; \bcreative direct ; \bart lead\b ; \bconceptual artist\b
        \bconcept artist\b ; \bdigital artist\b ; \bfine art\b ; \bphotograph ; \bvideograph ; \bcinematograph ; \bsound design ; \bmusic produc
        \baudio engineer ; \bvfx\b ; \bspecial effects\b ; \b3d artist\b ; \b3d model ; \bsculptor\b ; \bstoryboard ; \bcomic\b ; \bcartoon
        \bfootwear design ; \btextile design ; \bapparel design ; \bpackaging design ; \bprint design
    """,
    8: r"""
        \bcopywriter\b ; \bcreative writer\b ; \bcontent creator\b ; \bbrand design ; \bbrand identity\b ; \bcreative strateg ; \bcreative produc
        \bvisual storytell ; \bsocial media content\b ; \beditorial design ; \bweb design ; \bfront.end design ; \bcreative services\b ; \bcreative team\b
        \bcreative manager\b ; \bcreative lead\b ; \bcreative specialist\b ; \bsenior designer\b ; \blead designer\b ; \bstaff designer\b ; \bux researcher\b
        \buser research ; \bproduct designer\b ; \bspatial design ; \benvironmental design ; \bmusician\b ; \bcomposer\b ; \blyricist\b ; \bfilm\b.*\bproduc
        \bproduction design ; \bcontent design ; \bcreative content\b
    """,
    6: r"""
        \bmarketing design ; \bcampaign manag ; \bbrand manag ; \bcontent manag ; \bcontent strateg ; \bcontent market ; \bsocial media manag
        \bcommunity manag ; \bux\b ; \bui\b ; \buser experience\b ; \buser interface\b ; \bcreative\b ; \bdesign\b ; \bvisual\b ; \bwriter\b ; \beditor\b
        \bproducer\b ; \bstylish\b ; \bstylist\b ; \bfashion\b ; \barch(itect|itectur) ; \binterior\b ; \bgame dev ; \bgame artist\b ; \bphotoshop\b
        \bsketch\b.*\bdesign ; \bdigital market ; \becommerce.*design ; \bcreative ops\b ; \bcreative operat ; \bnarrat ; \bstorytell ; \bweb content\b
        \bcopyedit ; \bpost produc ; \bbroadcast
    """,
    4: r"""
        \bmarketing\b ; \bbrand\b ; \bcommunic ; \bsocial media\b ; \bpublic relation ; \bpr\b ; \bproduct manag ; \bprogram manag ; \bproject manag.*creative
        \bcreative.*project ; \bcustomer experienc ; \bcx\b ; \bcontent\b ; \bmedia\b ; \btraining.*design ; \binstructional design ; \bevent\b
        \bshow\b.*\bproduc ; \bstudio manag ; \bstudio operat ; \bdigital.*manag ; \bdigital prod
    """,
    2: r"""
        \bengine ; \bdevelop ; \bsoftware\b ; \bdata\b ; \banalyst\b ; \banalysis\b ; \bscient ; \bfinance\b ; \bfinancial\b ; \baccounting\b ; \boperat
        \blogistic ; \bsupply chain\b ; \bproject manag\b ; \bprogram manag\b ; \bhr\b ; \bhuman resource ; \brecruit ; \bsafety\b ; \bcomplian ; \blegal\b
        \bsales\b ; \bbusiness dev ; \baccount exec ; \bcustomer support\b ; \bcustomer service\b ; \bwarehouse\b ; \bmanufactur ; \bproduct ; \badmin\b
        \bcoordinat ; \bassistant\b
    """,
}
NEUTRAL_SCORE = 3

#: Ends of ASCII words for Java patterns, where ``\b`` would count accented letters.
OPEN, CLOSE = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"


def escaped(term: str) -> str:
    """A literal term in the common syntax of Java and RE2."""
    return re.sub(r"([.*+?^${}()|\[\]\\])", r"\\\1", term)


def words(terms: list[str]) -> str:
    """Java pattern: any of the terms as whole ASCII words, in any case."""
    return f"(?i){OPEN}(?:{'|'.join(map(escaped, terms))}){CLOSE}"


def sql_words(terms: list[str]) -> str:
    """The same for RE2, whose ``\\b`` is ASCII, as the body of an SQL string."""
    return (r"(?i)\b(?:" + "|".join(map(escaped, terms)) + r")\b").replace("'", "''")


def tier_patterns(spec: str) -> list[str]:
    """The patterns of a tier, as they are stated."""
    return [p for line in spec.strip().splitlines() for p in line.strip().split(" ; ")]


def java(pattern: str) -> str:
    """A pattern with ``\\b`` for Java, whose own counts accented letters as parts of words.

    Beside a plain letter or digit an edge is one look-around; elsewhere it is either.
    """
    out, at = [], 0
    for edge in re.finditer(r"\\b", pattern):
        before, after = pattern[at : edge.start()], pattern[edge.end() : edge.end() + 1]
        opens = re.fullmatch(r"[A-Za-z0-9_]", after) is not None
        closes = re.search(r"(?:^|[^\\])[A-Za-z0-9_]$", pattern[: edge.start()]) is not None
        out += [before, OPEN if opens and not closes else CLOSE if closes and not opens else f"(?:{OPEN}(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_]){CLOSE})"]
        at = edge.end()
    return "".join(out) + pattern[at:]


def java_any(patterns: list[str]) -> str:
    """One Java pattern for any of the patterns; those that open a word share that test."""
    opening = [java(p)[len(OPEN) :] for p in patterns if java(p).startswith(OPEN)]
    others = [java(p) for p in patterns if not java(p).startswith(OPEN)]
    return "|".join(([f"{OPEN}(?:{'|'.join(opening)})"] if opening else []) + [f"(?:{p})" for p in others])
