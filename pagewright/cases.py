"""Written cases of the rules: inputs, then what has to come out."""

JOB = "채용공고"
HEADINGS = [("💼 주요 업무 ✨", "주요 업무", False), ("★★★", "", True), ("[자격 요건]", "자격 요건", False), ("What you’ll do:", "What you'll do", False), ("", "", False), ("plain", "plain", False)]
BULLETS = [("•하나", "하나"), ("ㆍ 둘", "둘"), ("- 셋", "셋"), ("-3도", None), ("2026-08-01", None), ("– dash", "dash"), ("plain", None)]
LINE_VALUES = [
    ("회사 소개\n근무지: 서울 강남구\n활동 기간 : 3개월\n주최: 한빛재단", "서울 강남구", "3개월", "한빛재단"),
    ("nothing here", "", "", ""),
    ("근무 장소： 부산\n주관 : 가", "부산", "", "가"),
]
TITLES = [("가나다｜UI 디자이너", "", "가나다", "UI 디자이너"), ("공모전 | 포스터 공모", "주최: 한빛재단", "한빛재단", "포스터 공모"), ("제목만", "", "", "제목만"), ("A - B - C", "", "A", "B - C"), ("X｜", "", "X", "X｜")]
ROLE_LISTS = [
    ("UI 디자이너, 마케팅, 개발자 등 모집", ["UI 디자이너", "마케팅", "개발자"], True),
    ("그래픽 디자이너", [], False),
    ("(브랜드 디자이너 / 편집 디자이너) 채용", ["브랜드 디자이너", "편집 디자이너)"], False),
    ("디자인·운영", ["디자인", "운영"], True),
]
SECTION_KINDS = [
    ("주요업무", "duties"), ("💼 주요 업무", "duties"), ("(필수) 안내 [자격 요건]", "audience"), ("우대 사항 :", "preferred"), ("복지", "benefits"), ("문화 및 복지", "boundary"), ("사전 과제", "assignment"),
    ("전형 절차", "process"), ("자소서 문항", "essay"), ("WHAT YOU’LL DO", "duties"), ("주요 업무를 설명합니다", None), ("프로덕트 디자이너는 이렇게 일해요", "duties"), ("Design > Visual", "boundary"), ("", None),
]
CONTENT_TYPES = [
    ("제1회 포스터 공모전", [], "", None, "공모전"), ("Global design award challenge", [], "", None, "공모전"), ("프로덕트 디자이너", [], "", None, JOB), ("모두의 공간", ["신입/인턴"], "", None, JOB),
    ("모두의 공간", [], "", "https://x.example/careers/3", JOB), ("서포터즈 3기", [], "", None, "대외활동"), ("여름 과정", ["교육/대외활동"], "프로그램 안내", None, "교육·프로그램"),
    ("하는 법", [], "", None, "커리어 콘텐츠"), ("디자인 부트캠프", [], "", None, "교육·프로그램"), ("알림", [], "주요 업무 자격 요건", None, "기타·확인 필요"),
]
DESIGN_FIELDS = [("UI/UX 디자이너", "", ["UI/UX"]), ("디자이너", "그래픽 디자인과 영상 편집, 웹툰", ["그래픽", "영상/모션", "캐릭터/일러스트"]), ("BX디자인", "", []), ("BX 디자인", "", ["BX/브랜드"]), ("개발자", "", [])]
EXPERIENCE = [
    ("디자이너", [], "신입~3년", JOB, "경력무관", "신입~3년"), ("디자이너", [], "경력 무관", JOB, "경력무관", "경력 무관"), ("디자이너", [], "경력 3년 이상", JOB, "경력", "경력 3년 이상"),
    ("인턴 디자이너", [], "", JOB, "인턴", "인턴"), ("디자이너", ["신입/인턴"], "", JOB, "신입", "신입"), ("디자이너", ["주니어경력"], "", JOB, "경력", "경력"), ("디자이너", [], "", JOB, "확인 필요", ""),
    ("공모전", [], "경력 3년 이상", "공모전", "해당 없음", ""), ("디자이너", [], "이력서에 경력 3년 이상을 기재", JOB, "확인 필요", ""),
]
EMPLOYMENT = [("디자이너", "고용 형태: 정규직", ["정규직"]), ("채용연계형 인턴", "", ["전환형 인턴"]), ("디자이너", "향후 정규직 근무 형태 전환", []), ("체험형 인턴", "", ["인턴"]), ("파트타임 알바", "", ["아르바이트", "파트타임"])]
SCOPES = [
    (JOB, "프로덕트 디자이너", "", ["가"], False, "in_scope"), (JOB, "백엔드 개발자", "", ["가"], False, "non_design_role"), (JOB, "UI 디자이너, 개발자", "", [], False, "no_isolated_design_role"),
    (JOB, "UI 디자이너, 개발자", "", ["가"], False, "ambiguous_mixed_roles"), (JOB, "UI 디자이너, 개발자", "", ["Design > Visual"], False, "in_scope"), (JOB, "디자이너", "", ["Service & Business > PM"], False, "non_design_role"),
    ("공모전", "웹툰 공모전", "", [], False, "in_scope"), ("공모전", "아이디어 공모전", "", [], False, "non_design_opportunity"), ("커리어 콘텐츠", "디자이너 인터뷰", "", [], False, "non_design_opportunity"),
]
STATUS = [("모집", "마감된 공고입니다", None, "2026-08-12", "마감"), ("모집", "안내\n모집 종료\n감사합니다", None, "2026-08-12", "마감"), ("모집", "조기 마감될 수 있습니다", None, "2026-08-12", "모집 중"), ("모집", "", "2026-08-11", "2026-08-12", "마감"), ("모집", "", "2026-08-12", "2026-08-12", "모집 중")]
DEADLINES = [
    ("접수 기간: 2026.08.01 ~ 2026.08.20", "2026-08-01", "2026-08-12", "2026-08-20"), ("마감일\n8월 31일", "2026-08-01", "2026-08-12", "2026-08-31"), ("모집 기간: 12월 1일 ~ 1월 10일", "2026-12-01", "2026-12-05", "2027-01-10"),
    ("마감: 13월 40일", "2026-08-01", "2026-08-12", None), ("안내 2026.08.20", "2026-08-01", "2026-08-12", None), ("지원 기간 2월 29일까지", "2026-12-01", "2026-12-05", None), ("접수기간 9/3 ~ 9/10", None, "2025-08-12", "2025-09-10"),
    ("마감 2024년 2월 29일", "2026-08-12", "2026-08-12", "2024-02-29"),
]
PUBLISHED = [("2026-08-01T23:30:00+09:00", "2026-08-01"), ("2026-08-01", "2026-08-01"), ("게시 2026.8.3 오전", "2026-08-03"), ("어제", None), ("2026-13-01T00:00:00", None)]
POST_URLS = [
    ("/archives/12/?x=1#y", "https://site.example/design", "https://site.example/archives/12"), ("https://www.site.example/archives/7/", "https://site.example/", "https://www.site.example/archives/7"),
    ("https://other.example/archives/7", "https://site.example/", None), ("/archives/abc", "https://site.example/", None), ("archives/5", "https://site.example/", "https://site.example/archives/5"),
    ("//site.example/archives/9", "http://site.example/", "http://site.example/archives/9"), ("https://x]", "https://site.example/", None), ("mailto:a@site.example", "https://site.example/", None),
]
DOCUMENT_IDS = [("https://docs.example/page-0123456789ABCDEF0123456789abcdef?v=1", "01234567-89ab-cdef-0123-456789abcdef"), (" 01234567-89ab-cdef-0123-456789abcdef ", "01234567-89ab-cdef-0123-456789abcdef"), ("id 0123456789abcdef0123456789abcdef end", "01234567-89ab-cdef-0123-456789abcdef")]
WRAPS = [("short", ["short"]), ("", []), ("one two three four", ["one two", "three four"]), ("abcdefghijklmno", ["abcdefghij", "klmno"]), ("ab. cdefghij kl", ["ab.", "cdefghij", "kl"])]


def _b(*items: str) -> list[tuple[str, str]]:
    """h: a heading, - an item, anything else a paragraph."""
    kinds = {"h": "heading_3", "-": "bulleted_list_item"}
    return [(kinds.get(x.partition(" ")[0], "paragraph"), x.partition(" ")[2] if x.partition(" ")[0] in kinds else x) for x in items]


SECTIONS = [
    (_b("h 주요 업무", "- 가", "- 나", "h 자격 요건", "- 다", "h 우대 사항", "- 라", "h 혜택", "- 마"), "가\n나", "다", "라", "", "", "마"),
    (_b("주요 업무", "가", "접수 기간: 9월", "나", "지원 자격", "★★", "다"), "가", "다", "", "", "", ""),
    (_b("h 자격 요건", "- 가", "h 지원 자격", "- 가", "- 나"), "", "가\n나", "", "", "", ""),
    (_b("h 담당하실 업무에요", "- 자연", "h 주요 업무", "- 정식"), "정식", "", "", "", "", ""),
    (_b("h 사전 과제", "h 과제 안내", "- 포스터 한 장", "h 자소서 문항", "- 지원 동기"), "", "", "", "지원 동기", "과제 안내\n포스터 한 장", ""),
    (_b("h 자소서 문항", "- 자기소개서 제출"), "", "", "", "", "", ""),
    (_b("h 주요 업무", "- 가", "https://x.example/a", "- 나"), "가", "", "", "", "", ""),
    ([], "", "", "", "", "", ""),
]
LOGICAL = [
    (_b("지원", "자격", "요건", "내용"), ["audience", "audience", "audience", ""]),
    (_b("h 주요 업무", "가"), ["duties", ""]),
    (_b("문화 및", "복지", "내용"), ["boundary", "benefits", ""]),
]
_PAGE = "<html><head><meta property='og:title' content='{title} – SITE'></head><body><article><div class='entry-content'>{body}</div></article></body></html>"
PAGES = [
    (_PAGE.format(title="가나｜프로덕트 디자이너", body="<h3>주요 업무</h3><p>• 화면 설계<br>• 조사</p><h3>자격 요건</h3><ul><li>경력 3년 이상</li></ul>"), ["1"], ["가나｜프로덕트 디자이너"], [JOB], ["정상"], ["in_scope"]),
    (_PAGE.format(title="다라 인턴 채용", body="<h3>1. UI/UX 디자인 인턴</h3><h4>주요 업무</h4><p>화면</p><h3>2. 마케팅 인턴</h3><h4>주요 업무</h4><p>광고</p><h3>5. 그래픽 디자이너</h3><h4>주요 업무</h4><p>포스터</p>"), ["2-1", "2-5"], ["다라 인턴 채용｜1. UI/UX 디자인 인턴", "다라 인턴 채용｜5. 그래픽 디자이너"], [JOB, JOB], ["정상", "정상"], ["in_scope", "in_scope"]),
    (_PAGE.format(title="마바 디자이너 채용", body="<img src='a.png'>"), ["3"], ["마바 디자이너 채용"], [JOB], ["검토 필요"], ["in_scope"]),
    (_PAGE.format(title="사아 개발자·운영 채용", body="<h3>1. 마케팅 인턴</h3><p>가</p><h3>2. 개발 인턴</h3><p>나</p>"), [], [], [], [], []),
]

# What the page parser makes of written pages: title, published, categories, apply url, images, next page, blocks as kind|text.
_LONG = [f"{'가나다라마바사아자차카타파하' * 3}{i}" for i in range(7)]


def _parts(title="제목 미기재", published=None, categories=(), apply=None, images=False, next_href=None, blocks=()):
    return title, published, list(categories), apply, images, next_href, list(blocks)


PAGE_PARTS = [
    ("", *_parts()),
    # titles: meta before headings, section headings are none, the site's name goes
    ("<meta property='og:title' content='주요 업무'><meta name='twitter:title' content='여름 공모전 | SITE'><h1>자격 요건</h1>", *_parts("여름 공모전", blocks=["heading_2|자격 요건"])),
    ("<title>머리 제목 – SITE</title><main><h1>우대 사항</h1><p>가</p></main>", *_parts("머리 제목", blocks=["heading_2|우대 사항", "paragraph|가"])),
    ("<h1 class='other'>나중</h1><h1 class='entry-title'>먼저</h1>", *_parts("먼저", blocks=["heading_2|나중", "heading_2|먼저"])),
    # published: metas in their order, then a time element
    ("<meta name='date' content='2026-01-02'><meta property='article:published_time' content='2026-01-01T00:00:00Z'>", *_parts(published="2026-01-01T00:00:00Z")),
    ("<main><time>x</time><time datetime='2026-03-04'>y</time></main>", *_parts(published="2026-03-04")),
    # categories: links by rel, the section meta, links by address or box; only listed ones, each once
    ("<meta property='article:section' content='대외활동'><main><a href='/category/x'>취업토크</a><a rel='category tag' href='/c'>신입/인턴</a><a rel='tag' href='/d'>모름</a><div class='fusion-post-meta'><a href='/e'>커리어TV</a></div></main>", *_parts(categories=["신입/인턴", "대외활동", "취업토크", "커리어TV"])),
    # the way to apply: a label beats a known host, own links and broken ones do not count
    ("<main><a href='/own'>지원하기</a><a href='https://forms.example/1'>양식</a><a href='https://x]'>지원하기</a><a href='https://y.example/2'>신청하기</a></main>", *_parts(apply="https://y.example/2")),
    ("<main><a href='mailto:a@b.example'>지원하기</a><a href='https://careers.example/1'>양식</a></main>", *_parts(apply="https://careers.example/1")),
    # the next page of a listing
    ("<main><a class='next' href='/d/page/3/'>다음</a></main>", *_parts(next_href="https://site.example/d/page/3/")),
    ("<main><a class='next' href='/a'>x</a><a rel='next' href='/b'>y</a></main>", *_parts(next_href="https://site.example/b")),
    # the root: specific containers before article, the richest of them, empty ones pass
    ("<article><p>밖</p><div class='entry-content'></div><div class='post-content'><p>안</p><p>둘</p></div></article>", *_parts(blocks=["paragraph|안", "paragraph|둘"])),
    ("<main><p>하나</p></main><article><p>하나</p><p>둘</p></article>", *_parts(blocks=["paragraph|하나", "paragraph|둘"])),
    ("<body><p>몸</p><footer><p>발</p></footer></body>", *_parts(blocks=["paragraph|몸"])),
    # blocks of every kind
    ("<main><h2>가</h2><h5>나</h5><p>다</p><blockquote>라</blockquote><hr><ul><li>마</li></ul><ol><li>바<ul><li>사</li></ul></li></ol><table><tr><th>아</th><td>자</td></tr><tr><td></td></tr></table><img src='x'></main>",
     *_parts(images=True, blocks=["heading_2|가", "heading_3|나", "paragraph|다", "quote|라", "divider|", "bulleted_list_item|마", "numbered_list_item|바", "bulleted_list_item|사", "paragraph|아 | 자"])),
    # lines of a paragraph: bullets, decoration, the label of the way to apply
    ("<main><p>• 하나<br>- 둘<br>-3도<br>★★★<br>지원하기<br>셋</p></main>", *_parts(blocks=["bulleted_list_item|하나", "bulleted_list_item|둘", "paragraph|-3도", "paragraph|셋"])),
    # a strong line that is a section title is a heading; so is a bracketed one or one that fills its line
    ("<main><p><strong>주요 업무</strong></p><p>가</p><p>[자격 요건] 나<br>우대 사항<br>다</p></main>", *_parts(blocks=["heading_3|주요 업무", "paragraph|가", "heading_3|자격 요건", "paragraph|나", "heading_3|우대 사항", "paragraph|다"])),
    ("<main><p>자격 요건을 갖춘 분</p></main>", *_parts(blocks=["paragraph|자격 요건을 갖춘 분"])),
    # what trails is cut from a paragraph, and ends the walk in a heading
    ("<main><p>가 추천 콘텐츠 나</p><p>다</p><h3>최신 댓글</h3><p>라</p></main>", *_parts(blocks=["paragraph|가", "paragraph|다"])),
    # a text twice in one paragraph
    ("<main><p>한 줄<br>두 줄<br>한 줄<br>두 줄</p><p>같은 글 같은 글</p></main>", *_parts(blocks=["paragraph|한 줄", "paragraph|두 줄", "paragraph|같은 글"])),
    # the title does not open the body
    ("<main><h1>제목이다</h1><p>가</p></main>", *_parts("제목이다", blocks=["paragraph|가"])),
    # noise inside the root
    ("<main><nav><p>x</p></nav><script>var a = '<p>b</p>'</script><p>가<style>p{}</style></p><aside><p>y</p></aside></main>", *_parts(blocks=["paragraph|가"])),
    # adjacent equal blocks are one, headings stay; a heading that comes again without content goes
    ("<main><p>가</p><p>가</p><h3>나</h3><h3>나</h3><p>다</p><h3>나</h3></main>", *_parts(blocks=["paragraph|가", "heading_3|나", "heading_3|나", "paragraph|다"])),
    # two renderings of a long body: one stays
    ("<main>" + "".join(f"<p>{t}</p>" for t in _LONG * 2) + "</main>", *_parts(blocks=[f"paragraph|{t}" for t in _LONG])),
    # five equal blocks are too few to be a rendering
    ("<main>" + "".join(f"<p>{t}</p>" for t in _LONG[:5] * 2) + "</main>", *_parts(blocks=[f"paragraph|{t}" for t in _LONG[:5] * 2])),
    # the complete one of two renderings stays
    ("<main><h3>주요 업무</h3>" + "".join(f"<p>{t}</p>" for t in _LONG[:6]) + "<h3>주요 업무</h3>" + "".join(f"<p>{t}</p>" for t in _LONG) + "</main>", *_parts(blocks=["heading_3|주요 업무", *[f"paragraph|{t}" for t in _LONG]])),
]

# Blocks of one section: does a long run come again?
REPETITIONS = [
    ([("paragraph", t) for t in [*_LONG[:4], "사이", *_LONG[:4]]], True),
    ([("paragraph", t) for t in [*_LONG[:3], "사이", "둘", *_LONG[:3]]], False),
    ([("paragraph", t) for t in _LONG[:4]] + [("heading_3", "나")] + [("paragraph", t) for t in _LONG[:4]], False),
    ([("paragraph", str(i)) for i in [*range(4), 9, *range(4)]], False),
    ([("paragraph", t) for t in _LONG[:4]] + [("divider", ""), ("paragraph", "")] + [("paragraph", t) for t in _LONG[:4]], True),
    ([("paragraph", f"Ab{'c' * 40}{i}") for i in range(4)] + [("paragraph", f"aB{'C' * 40}{i}") for i in range(4)], True),
]

# Listing pages by number, status and post ids: the posts found in order, and their categories.
LISTING = [(1, "ok", [3, 1, 3]), (2, "ok", [1]), (3, "ok", [2]), (4, "ok", [2]), (5, "ok", [1]), (6, "ok", [9])]
LISTING_SHORT = [(1, "ok", [3, 1]), (2, "ok", [4]), (3, "not_found", []), (4, "ok", [8])]
DISCOVERED = [(LISTING, 0, ["3", "1", "2"]), (LISTING, 2, ["3", "1"]), (LISTING, 1, ["3", "1"]), (LISTING_SHORT, 0, ["3", "1", "4"]), ([(1, "not_found", [])], 3, [])]

# Whole pages: the reasons for a second look, and the warnings of a run.
QUALITY = [
    (PAGES[0][0], [], ["no_employment_type"]),
    (_PAGE.format(title="마바 디자이너 채용", body="<img src='a.png'>"), ["missing_body", "missing_job_duties", "image_only_content"], ["empty_body", "no_employment_type"]),
    (_PAGE.format(title="주요 업무", body="<p>글</p>"), ["suspicious_title"], ["unclassified"]),
    (_PAGE.format(title="가 디자이너 채용", body="<p>고용 형태: 정규직</p><h3>주요 업무</h3><p>가</p><h3>자격 요건</h3><h3>우대 사항</h3><h3>자소서 문항</h3><p>자기소개서 제출</p><h3>사전 과제</h3>"), ["empty_qualifications_section", "empty_preferred_section", "empty_essay_questions_section", "empty_pre_assignment_section"], []),
    (_PAGE.format(title="가 디자이너 채용", body="<p>인턴</p><h3>주요 업무</h3>" + "".join(f"<p>{t}</p>" for t in [*_LONG[:4], "사이", *_LONG[:4]])), ["unresolved_repetition"], []),
    (_PAGE.format(title="제1회 포스터 공모전", body="<p>누구나</p>"), [], []),
]

# Body lines and section texts: do the sections stand in the body and hold content only?
CONSISTENT = [
    (["가나다", "라"], "가나다", "라", True), (["가나다", "라"], "가나", "", True), (["가나다"], "나다", "", False), (["가", "https://x.example/a"], "가\nhttps://x.example/a", "", False),
    (["주요 업무", "가"], "주요 업무\n가", "", False), (["가", "★★★"], "가\n★★★", "", False), (["1. UI/UX 디자이너 인턴", "가"], "", "1. UI/UX 디자이너 인턴", False), (["1. UI 디자이너 인턴", "가"], "", "1. UI 디자이너 인턴", True), (["가"], "", "", True), ([], "가", "", False),
]

# Blocks: those short enough to be a heading, with their section.
CANDIDATES = [
    (_b("h 자격 요건", "💼 주요 업무", "글"), ["0|heading_3|자격 요건|자격 요건|qualifications", "1|paragraph|💼 주요 업무|주요 업무|duties", "2|paragraph|글|글|-"], True, False),
    (_b("가" * 101, "h 우대 사항", "- 나"), ["1|heading_3|우대 사항|우대 사항|preferred", "2|bulleted_list_item|나|나|-"], False, True),
    (_b("가" * 100), ["0|paragraph|" + "가" * 100 + "|" + "가" * 100 + "|-"], False, False),
    ([], [], False, False),
]

# Lines: an address alone, never content, guidance on resumes, a cover letter asked for, a section title, trailing noise.
LINES = [
    ("https://x.example/a", True, True, False, False, False, False), ("자세히: https://x.example/a", False, False, False, False, False, False), ("사전과제 확인하기", False, True, False, False, False, False),
    ("Design > Visual", False, True, False, False, False, False), ("이력서에 경력을 기재", False, False, True, False, False, False), ("국문 이력서 및 자기소개서 제출", False, False, False, True, False, False),
    ("자기소개서를 읽고", False, False, False, False, False, False), ("[주요 업무]", False, True, False, False, True, False), ("주요 업무 (공통):", False, False, False, False, True, False), ("함께 보면 좋은 커리어 정보", False, False, False, False, False, True), ("★★★", False, True, False, False, False, False),
]

# A property's kind and what it holds: its text.
PROPERTIES = [("title", ["가", "나"], None, None, "가나"), ("rich_text", [], "u", "n", ""), ("url", ["가"], "https://x.example/", None, "https://x.example/"), ("select", None, None, "마감", "마감"), ("url", None, None, None, ""), ("number", ["1"], "u", "n", "")]

_STRINGS = ["key_duties", "target_audience", "qualifications", "preferred_qualifications", "essay_questions", "pre_assignment"]
# Stored columns: the required ones that are missing, of a wrong type, and those a migration adds.
SCHEMAS = [
    (", ".join(f"{n} string" for n in _STRINGS), [], [], []),
    ("title string, key_duties string, target_audience string", _STRINGS[2:], [], _STRINGS[2:]),
    ("key_duties int, target_audience string, qualifications string, preferred_qualifications string", _STRINGS[4:], ["key_duties"], _STRINGS[4:]),
    ("qualifications array<string>", [n for n in _STRINGS if n != "qualifications"], ["qualifications"], ["wrong type: qualifications"]),
]

# Settings as written: mode, dry run, pages to read, posts at most, delay.
SETTINGS = [
    ({}, "recent", False, 3, 0, "2.5"), ({"MODE": "full", "DRY_RUN": " Yes "}, "full", True, 0, 0, "2.5"), ({"LIST_PAGES": "7", "MODE": " full "}, "full", False, 7, 0, "2.5"),
    ({"MAX_POSTS": " ", "RECENT_PAGES": "5", "DELAY_SECONDS": "1.5", "DRY_RUN": "no"}, "recent", False, 5, 0, "1.5"), ({"MODE": "all"}, "ValueError", False, 0, 0, ""), ({"MAX_POSTS": "x"}, "ValueError", False, 0, 0, ""),
]

# Answers of a site (0: no connection), the robots file first: what a fetch ends with, the waits, the requests.
FETCHES = [
    ("/a", [(404, ""), (200, "x")], "ok", [], 2), ("/private/a", [(200, "User-agent: *\nDisallow: /private")], "blocked", [], 1), ("/a", [(404, ""), (404, "")], "not_found", [], 2),
    ("/a", [(404, ""), (403, "")], "blocked", [], 2), ("/a", [(404, ""), (429, "")], "rate_limited", [], 2), ("/a", [(404, ""), (410, "")], "error", [], 2), ("/a", [(404, ""), (0, ""), (200, "x")], "ok", ["2"], 3),
    ("/a", [(404, ""), (500, ""), (503, ""), (200, "x")], "ok", ["3", "6"], 4), ("/a", [(0, ""), (0, ""), (0, ""), (0, "")], "error", ["2", "4"], 4),
]

# Answers of a store: status, header of the wait, body; what a request ends with, the waits, the requests.
REQUESTS = [
    ("t", [(200, "", '{"id": "a"}')], "a", [], 1), ("t", [(204, "", "")], "", [], 1), ("t", [(429, "7", ""), (429, "", ""), (200, "", '{"id": "b"}')], "b", ["7", "4"], 3),
    ("t", [(500, "", "")] * 4 + [(200, "", '{"id": "c"}')], "c", ["2", "4", "6", "8"], 5), ("t", [(500, "", "down")] * 5, "HTTP 500 [unknown_error] GET /x: down", ["2", "4", "6", "8"], 5),
    ("t", [(400, "", '{"code": "bad", "message": "no such", "request_id": "r1"}')], "HTTP 400 [bad] GET /x: no such (request_id=r1)", [], 1), ("t", [(429, "1", "")] * 5, "GET /x was refused 5 times", ["1"] * 5, 5),
    ("t", [(404, "", "")], "HTTP 404 [unknown_error] GET /x: no body", [], 1), (" ", [], "the remote store needs a token", [], 0),
]
