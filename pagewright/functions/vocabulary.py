"""The headings, labels and patterns that decide what a page's text means.

They are data. Everything that reads them builds its expressions from them.
"""

# fmt: off
# Left sides of a title that name a kind of posting and not an organisation.
GENERIC_PREFIXES = {
    "대외활동",
    "공모전",
    "교육",
    "교육/대외활동",
    "신입/인턴",
    "주니어경력",
    "채용",
}

# The site categories that count.
CATEGORY_WHITELIST = {
    "신입/인턴",
    "주니어경력",
    "교육/대외활동",
    "대외활동",
    "커리어TV",
    "취업토크",
}

# Parts of a page that are not content.
NOISE_SELECTORS = [
    "script",
    "style",
    "noscript",
    "iframe",
    "form",
    "nav",
    "footer",
    "aside",
    ".sharedaddy",
    ".jp-relatedposts",
    ".related-posts",
    ".fusion-sharing-box",
    ".fusion-meta-info",
    ".post-meta",
    ".comments-area",
    ".single-navigation",
    ".fusion-post-title-meta-wrap",
    ".yarpp-related",
    ".adsbygoogle",
    ".fusion-comments-tb",
    ".fusion-related-posts",
    ".fusion-post-cards",
    ".related-posts-wrapper",
    ".recent-comments",
]

# Section headings by kind; earlier kinds win.
SECTION_HEADINGS = {
    "duties": (
        "담당하실 업무에요", "담당 업무 |", "이런 업무를 하게 되실 거예요",
        "담당 업무 | 이런 업무를 하게 되실 거예요", "주요업무(3개월 단기 MVP)",
        "우리 팀과 함께할 미션을 소개합니다", "함께할 미션을 소개합니다",
        "합류하면 아래와 같은 업무를 하게 됩니다",
        "저희와 함께 하시게 될 일들이에요", "저희와 함께 하게 될 일들이에요",
        "함께 하시게 될 일들이에요", "함께 하게 될 일들이에요",
        "이런 일을 합니다", "이런 일을 해요", "이런 일을 하게 됩니다", "담당하게 될 일",
        "이런 일을 함께해요", "이런 경험을 할 수 있어요", "이런 업무를 함께 할 예정이에요",
        "이런 업무를 담당해요", "합류하면 함께 할 업무예요", "합류하면 함께할 업무예요",
        "주요 업무", "주요 업무 및 역할", "주요업무 및 역할", "담당 업무", "담당업무 및 역할",
        "담당하실 업무", "수행 업무", "업무 내용",
        "하실 일", "역할",
        "Responsibilities", "What you'll do", "What you will do", "Your role",
    ),
    "audience": (
        "공통지원자격", "공통 지원 자격",
        "필요 역량", "필요역량", "필요 역량 및 경험", "필요 역랑 및 경험",
        "필요 역량과 경험", "필요한 역량 및 경험",
        "이런 경험이 있는 분을 찾고 있어요",
        "자격 요건 | 이런 분과 함께하고 싶어요",
        "우리는 이런 분을 찾고 있어요", "우리는 이런 분을 찾습니다",
        "이런 분을 모시고 싶어요", "이런 분을 모시고 싶습니다",
        "이런 분을 모시고 있어요", "이런 분을 찾고 있어요", "이런 분을 찾습니다",
        "이런 분을 찾아요", "우리가 찾는 분", "이런 분을 기다립니다",
        "이런 분과 함께하고 싶어요", "이런 분과 함께하고 싶습니다", "이런 역량을 가진 분을 찾아요",
        "지원 자격", "지원자격", "자격 요건", "자격요건",
        "필수 사항", "필수 요건", "필수 자격", "지원자격 및 요건", "지원 자격 및 요건",
        "자격요건 및 역량", "지원 대상", "Requirements", "Qualifications",
        "Required", "Required Qualifications", "What we're looking for", "Who you are",
    ),
    "preferred": (
        "우대 지원자격", "What Will Give You A Competitive Edge",
        "우대 조건", "우대조건", "이런 경험이 있다면 더 큰 시너지를 낼 수 있어요",
        "우대 사항 | 이런 경험을 가지신 분이라면 더 좋아요",
        "이런 분이면 더더욱 환영해요", "이런 분이면 더 좋아요", "이런 분이면 좋습니다",
        "이런 경험을 우대합니다", "있으면 좋은 경험", "이런 경험이 있다면 더욱 좋아요",
        "이런 경험이 있다면 더 좋아요", "이번 채용은 이런 분을 우대해요",
        "우대 사항", "우대사항", "우대사항 및 역량", "우대 사항 및 역량", "우대 요건", "우대 자격",
        "Preferred Qualifications",
        "Preferred", "Nice to have", "Nice-to-have", "Plus if you have",
    ),
    "benefits": (
        "혜택", "혜택 및 복지", "복지", "복지혜택", "복지 혜택", "복리후생",
        "디밀은 이렇게 일해요", "이런 혜택을 드려요",
        "지원 내용", "참여 혜택", "활동 혜택", "상금", "시상 내역",
    ),
    "conditions": (
        "고용 조건", "근무환경", "근무 환경", "근무 조건", "근무 형태", "근무 장소", "근무지",
        "인턴 근무지", "인턴기간", "인턴 기간", "꼭 확인해주세요",
    ),
    "process": (
        "How we Hire",
        "채용은 이렇게 진행돼요", "전형 절차 및 일정", "지원 전 꼭 확인해 주세요", "참고 사항",
        "지원서류", "인재영입 프로세스", "채용 절차", "이력서는 이렇게 작성하시는 걸 추천해요",
        "토스로의 합류여정", "채용 전형", "합류 여정", "전형 절차", "지원 절차", "지원 방법",
        "지원 서류", "제출 서류",
    ),
    "essay": (
        "자기소개서 문항", "자기 소개서 문항", "자소서 문항", "지원서 문항", "에세이 문항",
        "지원서 질문", "자기소개서 질문", "작성 문항", "지원 시 작성해 주세요", "지원 시 작성해주세요",
        "Essay Questions", "Application Questions", "Written Questions",
    ),
    "assignment": (
        "사전과제", "사전 과제", "사전과제로 지원하기", "과제 전형", "직무 과제", "디자인 과제", "디자인 테스트",
        "실무 과제", "과제 안내", "제출 과제", "과제 제출", "사전 테스트", "Assignment",
        "Take-home Assignment", "Take Home Assignment", "Design Test", "Task", "Practical Test",
    ),
}
# Headings that end a section without starting one.
SECTION_BOUNDARY_HEADINGS = (
    "문화 및 복지", "문화 및", "복지", "복리후생", "혜택", "마감기한", "마감 기한",
    "접수 기간", "접수기간", "접수 마감", "지원서 접수 마감", "마감일", "게시일", "등록일",
    "채용 시 마감", "기타 사항", "유의사항", "회사 소개",
    "팀 소개", "포지션 소개", "채용 배경", "지원 시 직군/직무 설정", "직군/직무 설정",
    "포트폴리오로 지원하기", "토스플레이스로의 합류 여정",
    "이런 분이면 잘 맞습니다", "이런 분이면 잘 맞아요",
    "이런 분과 잘 맞습니다", "이런 분과 잘 맞아요",
    "합류 과정", "합류 프로세스", "채용 여정",
    "최고의 동료와 함께, 성장에만 집중하세요",
    "최고의 동료와 함께 성장에만 집중하세요", "복지 및 문화",
    "성장 지원", "성장을 위한 전폭적인 지원",
    "이렇게 성장할 수 있어요", "이렇게 성장할 수 있습니다",
    "합류 여정 안내드려요", "바이트랩 합류 여정 안내드려요",
    "크래프톤의 도전에 함께 하기 위해 아래의 전형 과정이 필요합니다",
    "아래의 전형 과정이 필요합니다", "전형 과정",
    "필요 서류를 확인해주세요", "아래 안내 사항을 확인해주세요",
    "서류 작성 TIP", "지원서 작성 TIP", "지원 안내", "지원서 작성 안내",
    "채용 단계", "채용 조건", "전형절차 및 안내 사항", "전형 절차 및 안내 사항",
    "서류 접수", "과제 Test", "미팅", "처우 제안", "처우협의", "최종합격",
    "업무 시작", "세부 안내",
)
