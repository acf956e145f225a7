"""Rule packs as data: (rule, Java pattern)."""

from __future__ import annotations

# Patterns that results must agree on.
FACTS = {
    "absolute_date": r"(?:\d{4}년\s*)?\d{1,2}월\s*\d{1,2}일|\d{4}[./-]\d{1,2}[./-]\d{1,2}",
    "relative_time": r"오늘|내일|어제|다음 날|그날 밤|며칠 후|몇 시간 후|잠시 후|한 달 후|이틀 뒤|사흘 뒤|보름 뒤|일 년 후",
    "date": r"(?:\d{4}년\s*)?\d{1,2}월\s*\d{1,2}일|\d{4}[./-]\d{1,2}[./-]\d{1,2}|(?:오늘|내일|어제|다음 날|그날 밤|며칠 후|몇 시간 후|잠시 후|한 달 후|이틀 뒤|사흘 뒤|보름 뒤|일 년 후)",
    "date_with_weekday": r"(?:\d{4}년\s*)?\d{1,2}월\s*\d{1,2}일\s*(?:월|화|수|목|금|토|일)요일",
    "time": r"(?:오전|오후|새벽|정오|자정)\s*\d{1,2}시(?:\s*\d{1,2}분)?|\d{1,2}:\d{2}",
    "money": r"\d+(?:\.\d+)?\s*(?:억|조|만|천만|백만)?\s*(?:원|달러|위안|엔|냥|관|전)",
    "percent": r"\d+(?:\.\d+)?\s*%|\d+(?:\.\d+)?\s*퍼센트",
    "age": r"\d{1,3}\s*세|약관|이립|불혹|지천명|환갑|고희",
    "title_or_role": r"[가-힣A-Za-z0-9]{2,20}\s*(?:회장|대표|팀장|부장|과장|실장|장로|궁주|맹주|소저|공자|도련님|사부|스승|PB)",
    "kin_title": r"[가-힣A-Za-z0-9]{1,20}\s*(?:아버지|어머니|부친|모친|숙부|숙모|형님|누님|오라버니|동생|사촌|정혼자|장인|장모|사위|며느리|할아버지|할머니)",
    "speaker_cue": r"[가-힣A-Za-z0-9]{2,20}(?:이|가|은|는)?\s*(?:말했다|물었다|중얼거렸다|외쳤다|답했다|웃었다|고개를 끄덕였다)",
    "inline_author_memo": r"@\s*(?:부연|추가|메모|수정|확인)[^\n]*|^\s*@\S+[^\n]*",
    "era_or_modern_tone_candidate": r"스마트폰|핸드폰|인터넷|온라인|브리핑|쇼|퍼즐|레이저|스파크|타이밍|스위치|스포일러|콤비|갑질|독고다이",
    "inline_paren_error": r"/[^/\n]{1,80}\([^)\n]{1,80}\)/|//[^/\n]{1,120}//",
}
HYGIENE = {
    "author_note_marker": r"^\s*@\S+|@\s*(?:부연|추가|메모|수정|확인)",
    "slash_swap_marker": r"/[^/\n]{1,80}\([^)\n]{1,80}\)/",
    "html_entity": r"&(?:nbsp|lt|gt|amp|quot|apos|#\d+);",
    "markdown_header": r"^#{1,6}\s+\S+",
    "strike_marker": r"<s>.*?</s>|~~[^~]+~~",
    "correction_marker": r"ⓐⓐ?\{[^|{}]*\|[^{}]*\}",
}
SURFACE = {
    "chapter_end_meta": r"\(제\s*\d+\s*화\s*끝\)",
    "part_end_meta": r"\(파트\s*\d+\s*완결\)|\(.*?완결\s*\)",
    "legacy_name_parenthetical": r"[A-Za-z가-힣0-9·]+\(구\s*[^)\n]{1,30}\)",
    "english_parenthetical_gloss": r"[A-Za-z][A-Za-z0-9 ,.!?'\-…]{2,80}\([가-힣][^)\n]{1,60}\)",
    "placeholder_surface": r"(?<![A-Za-z0-9가-힣])[A-D]사(?=$|[\s,.;:!?)]|[은는이가을를과와도에의])|20XX|XX년|OOO|○○",
    "internal_memo_surface": r"TODO|FIXME|검수자|편집자\s*메모|작가\s*메모|내부\s*메모|수정\s*필요",
    "ai_tool_surface": r"ChatGPT|GPT-|AI-slop|ai-slop|인공지능이\s*작성",
}
MINIMUM_CHAPTER_CHARS = 4000
NOTE_TERMS = ("TODO", "TBD", "FIXME", "작가", "편집", "교정", "검수", "수정", "삭제", "추가", "확인", "메모", "보강", "복선", "설정", "나중에", "여기", "장면", "대사", "묘사", "삽입", "정리")
SCREEN_TERMS = (
    "뉴스", "속보", "헤드라인", "로이터", "블룸버그", "외신", "통신사", "단말기", "터미널", "화면", "모니터", "자막", "텍스트", "알림", "전광판", "문자", "메시지",
    "보고서", "브리핑", "기사", "신문", "방송", "앵커", "공시", "차트", "HTS", "호가창", "로그",
)
HEADLINE_TERMS = (
    "미국", "중국", "일본", "한국", "유럽", "UN", "WTI", "원유", "유가", "금리", "환율", "달러", "주가", "지수", "시장", "모기지", "연체율", "가격", "하락세", "상승세",
    "계약", "정부", "대통령", "발표", "선언", "공시", "긴급", "속보",
)
HEADLINE_SHAPE = r"[.。]|상승|하락|급등|급락|발표|선언"
STATES = {
    "anchor": r"(?:\d{4}년\s*)?\d{1,2}월\s*\d{1,2}일|\d{1,2}:\d{2}|오늘|금일|당일|어제|내일|다음 날|그날|같은 날|방금|조금 전|잠시 후|며칠 후|그날 밤|그날 오전|그날 오후|새벽|아침|정오|저녁|밤|하루 뒤|이튿날",
    "negation": r"않|안\s|못|없(?:다|었다|었|고|는|어|음|을|다면|지만|지)|금지|거부|불가|중단|철회|취소|보류|미수행|미완|아직",
    "affirmation": r"했|했다|마쳤|완료|끝냈|확인|승인|서명|시작|유지|넣|눌렀|받았|보냈|만났|나섰|들어갔",
    "plan": r"해야\s*했|해야\s*한다|하려|할 생각|할 계획|예정|준비|기다리|필요",
    "hard_affirmation": r"마쳤|완료|끝냈|확인했다|승인|서명|눌렀|넣었|받았|보냈|만났",
    "trace": r"이미|아직|더 이상|처음|다시|결국|마침내|한 번도|단 한",
}
ACTIONS = {
    "report": r"보고|연락|통화|전화|회선",
    "trade_order": r"매수|매도|청산|주문|포지션|계약|호가|진입",
    "approval": r"승인|결재|허가|가승인|본승인|한도",
    "signing": r"서명|신청서|해지|서류|계약서",
    "money_flow": r"이체|송금|입금|출금|현금화|분리|동결|자금",
    "visit_movement": r"방문|외출|나섰|나갔|돌아|들어갔|빠져나왔",
    "meeting": r"만났|상담|대화|대면|불렀|호출",
    "knowledge": r"알았|몰랐|확인|기억|눈치|파악",
}
SUBTITLE_ENDING = r"(?:다|요|죠|했다|였다|한다|었다|았다)[.!?…]*$"
MARKERS = ("ⓐ", "ⓐⓐ", "")
OPERATIONS = ("replace", "delete", "insert_before", "insert_after")
CONTEXTUAL_CLASSES = ("contextual_typo", "contextual_typo_fix", "contextual_word_error", "contextual_grammar")
CONTEXTUAL_SIGNALS = ("11자", "11자의 틈새", "제품에", "피난 주", "숙식간", "정도록", "책임의무게", "말하지마요", "고았다", "튀어 나왔다")
SLOP_CLASSES = ("ai_slop_cleanup", "repetition_cleanup", "rhythm_cleanup", "abstract_intensifier_cleanup")
MEMO_PHRASES = ("판단 필요", "정본 확정 필요", "확정 전 보류", "여부 판단", "판단 여부", "backpatch", "역방향 보정 필요", "독자 반감 위험")
REJECTED_STATUSES = ("rejected", "reject", "withdrawn", "철회", "반려")
APPROVED_STATUSES = ("approved", "accepted", "done", "승인", "확정", "완료")
LEDGER_STATUSES = (
    "confirmed_error", "confirmed_internal_marker", "accepted_direct", "contextual_canon", "canon_hold", "blocking_hold", "policy_watchlist", "style_watchlist", "ledger_needed",
    "policy_choice", "genre_allowed", "blocked", "needs_human", "style_only", "reseal_required", "sealed", "rejected",
)
ROLE_SUFFIXES = ("회장", "대표", "팀장", "부장", "과장", "실장", "장로", "궁주", "맹주", "소저", "공자", "도련님", "사부", "스승", "PB")
KIN_SUFFIXES = ("아버지", "어머니", "부친", "모친", "숙부", "숙모", "형님", "누님", "오라버니", "동생", "사촌", "정혼자", "장인", "장모", "사위", "며느리", "할아버지", "할머니")
HARD_CARRYOVER_KINDS = ("date", "date_with_weekday", "absolute_date", "relative_time", "time", "money", "percent", "title_or_role", "kin_title", "state_carryover")
#: (subtype, value, replacement, pattern, severity)
PROOFREAD = (
    ("surface_typo", "피난 주", "피난 중", r"피난\s+주(?=에도|에|에는|를|가|\b)", "P3"),
    ("surface_typo", "숙식간", "순식간", r"숙식간", "P3"),
    ("surface_typo", "정도록", "정도로", r"정도록", "P3"),
    ("surface_spacing", "책임의무게", "책임의 무게", r"책임의무게", "P3"),
    ("surface_spacing", "말하지마요", "말하지 마요", r"말하지마요", "P3"),
    ("surface_typo", "고았다", "고왔다", r"고았다", "P3"),
)
EMBRACE = r"제품에\s*(?:끌어안|껴안|안으며|안고)"
NUMERIC_GAP = r"\b11자(?:의)?\s*틈새"
NIB = r"슬릿|펜촉|모세관|이리듐"
#: Feature: (terms, weight, density of the full weight).
DENSITIES = {
    "stock_reaction_density": (("숨을 삼켰다", "마른침", "입을 열었다", "시선을 돌렸다", "고개를 끄덕였다", "눈을 크게 떴다", "입을 다물지 못했다", "침묵이 내려앉았다"), 18, 8),
    "abstract_intensifier_density": (("완벽한", "완벽하게", "거대한", "차가운", "서늘한", "압도적인", "압도감", "본능적으로", "운명적인", "기묘한", "묵직한"), 16, 10),
    "dramatic_cadence_density": (("그야말로", "말 그대로", "순식간에", "한순간", "어느새", "그 순간", "바로 그때", "그때였다", "마침내", "결국", "더 이상"), 16, 12),
    "metaphor_density": (("마치", "듯했다", "듯한", "것처럼", "처럼", "같았다", "같은"), 12, 14),
}
# End of the fixed values.

#: For text in Latin script.
LATIN_FACTS = {"percent": r"\d+(?:\.\d+)?\s*%", "email": r"[a-z0-9._]+@[a-z0-9.]+\.[a-z]+", "number": r"\d+", "license": r"[Ll]icensed under|[Cc]opyright"}
LATIN_TERMS = ("the ", "tion", " and ", "ing ")
LATIN_STATES = {"anchor": r"[Tt]he [a-z]{2}|[Dd]ie [a-z]{2}", "negation": r" of | von ", "affirmation": r" and | und ", "plan": r"would|muss", "hard_affirmation": r"done", "trace": r"again|wieder"}
LATIN_ACTIONS = {"tion": r"tion", "lich": r"lich", "ing": r"ing "}
