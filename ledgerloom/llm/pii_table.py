"""The small labelled table: sentences with marked places, and what stands there. All content is invented."""

from __future__ import annotations

import random
import re

#: Common names of persons by language. No entry of this module stands in the test documents (tested).
SURNAMES = {
    "ja": "佐藤 鈴木 高橋 田中 伊藤 渡辺 山本 中村 小林 加藤 吉田 山田 佐々木 山口 松本 井上 木村 斎藤 清水 山崎 池田 橋本 阿部 石川 山下 石井 小川 前田 岡田 長谷川 藤田 後藤 近藤 村上 遠藤 青木 坂本 福田 太田 西村 藤井 金子 岡本 藤原 三浦 五十嵐 宇都宮".split(),
    "zh": "王 李 张 刘 陈 杨 赵 黄 周 吴 徐 孙 胡 朱 高 林 何 郭 马 罗 梁 宋 郑 谢 韩 唐 冯 于 董 萧 程 曹 袁 邓 许 傅 沈 曾 彭 吕 苏 卢 蒋 蔡 贾 丁 魏 薛 叶 阎 欧阳 上官 诸葛 夏侯 皇甫 尉迟 公孙 宇文 长孙 钟离".split(),
    "ko": "김 이 박 최 정 강 조 윤 장 임 한 오 서 신 권 황 안 송 류 전 홍 고 문 양 손 배 백 허 유 남 심 노 하 곽 성 차 주 우 구 민 진 엄 채 원 천 방 공 현 함 변 염 여 추 도 소 석 설 마 길 연 위 표 명 기 반 왕 금 옥 육 맹 동방 서문 어금".split(),
    "en": "Smith Johnson Williams Brown Jones Taylor Davies Wilson Evans Thomas Roberts Walker Wright Robinson Thompson White Hughes Edwards Green Clarke Wood Harris Lewis Martin Jackson Hall Turner Cooper Hill Ward Morris Moore Clark King Baker Harrison Morgan Allen James Scott Phillips Watson Davis Parker Bennett O'Neill McKenzie Fitzgerald".split(),
    "fr": "Martin|Bernard|Dubois|Durand|Lefèvre|Moreau|Laurent|Simon|Michel|Garcia|Roux|Fournier|Girard|Bonnet|Lambert|Rousseau|Faure|Mercier|Blanchard|Guérin|Boyer|Garnier|Chevalier|Le Goff|de La Tour".split("|"),
    "pt": "Silva|Souza|Oliveira|Santos|Pereira|Lima|Carvalho|Ferreira|Rodrigues|Almeida|Costa|Gomes|Martins|Araújo|Melo|Barbosa|Ribeiro|Cardoso|Teixeira|Correia|Gonçalves|dos Anjos|da Rocha".split("|"),
}
GIVEN = {
    "ja": "太郎 花子 健一 由美子 翔太 陽子 誠 恵子 拓也 直樹 美咲 さくら あかり ひろし 大輔 智子 和彦 真由美 康弘 ケンジ".split(),
    "zh": "伟 芳 娜 敏 静 强 磊 洋 艳 勇 军 杰 涛 明 超 秀英 霞 平 刚 桂英 建国 晓明 丽娟 志强 海燕 文博 子涵 雨欣".split(),
    "ko": "민준 서연 지훈 수빈 영수 미영 현우 지은 동현 은지 성호 혜진 재영 유진 승현 하늘".split(),
    "en": "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen Daniel Nancy Matthew Lisa Anthony Margaret Mark Sandra Paul Ashley".split(),
    "fr": "Jean Marie Philippe Nathalie Nicolas Isabelle Julien Sophie Pierre Catherine François Hélène Jean-Luc Anne-Laure Gérard Chloé".split(),
    "pt": "João Maria José Ana Pedro Francisca Carlos Antônia Paulo Adriana Lucas Juliana Luiz Márcia Rafael Fernanda Tiago Letícia".split(),
}
#: Characters and syllables that names are made of. Most names are put together from them by rule, so that the field sees
#: few words twice within a name and learns what stands around it.
PARTS = {
    "ja": ("田中山川村木林森本井上下野原岡島崎谷松竹梅藤橋池石清水大小高西東北南青赤黒白金福吉前後沢坂岩今黄新古宮内外永長平和豊浜津江河瀬波風雲雪霜花葉根桑栗柿杉桜柳稲麦米倉鷹鶴亀馬熊", "一二三太郎子美恵智和幸正明雄夫男彦介輔也樹斗翔翼優陽菜結愛奈々香里沙織真由紀久保弘浩文武勇健康隆秀英俊博哲也信義孝忠光輝晴朗"),
    "zh": ("", "伟芳娜敏静丽强磊军洋勇艳杰娟涛明超秀霞平刚桂英华玉萍红梅建国志文海燕晓东春雪琳欣怡婷佳宇轩浩然子涵雨辰思远博雅俊逸嘉诗语泽瑞林峰山川江河松柏竹兰菊荷月阳光辉"),
    "ko": ("", "가나다라마바사아자하강건경고관광교구규균근기나남노다대덕도동두라란람래려련로루류린림마만명모목무문미민바방배범별병보복봄빈빛상새서석선설섬성세소솔송수숙순승시신심아안애연열영예오옥온완용우운원월유윤은의이인일자잔장재전정제조종주준중지진찬창채천철청초춘치태평하한해향현형혜호홍화환효훈휘희"),
}
SYLLABLES = {
    "en": ("b br bl c ch cl cr d dr f fl fr g gl gr h j k l m n p pl pr r s sh sl st str t th tr v w wh y z".split(), "a e i o u a e i o u ai ea ee ou oo".split(), "n r l s t m d k th ck ll ss nd rt rn lt st ng x".split()),
    "fr": ("b br c ch cl d dr f fl g gr j l m n p pr r s t tr v".split(), "a e i o u é è ai au ou eau oi ie".split(), "n r l s t nd rt gne lle sse que ".split(" ")),
    "pt": ("b br c ch d f g gr j l lh m n nh p pr r s t tr v".split(), "a e i o u á ã é ó ei ou ão".split(), "l r s m n z        ".split(" ")),
}
#: Number shapes; 9 stands for any digit, A for a capital letter.
PHONES = (
    "99-9999-9999|99(9999)9999|990-9999-9999|+99 9 9999 9999|(99)9999-9999|+99 999 9999 9999|999-99999999|(0999)99999999|+99 99 9999 9999|99999999999|99-999-9999|(999) 999-9999|999.9999.9999|"
    "+99-9-9999-9999|999.9999.9999 ext. 99|999-9999-9999|+99 9999 999999|999 9999 9999|(999) 999-9999|+9 999-999-9999|00 99 9999 999 999|+99 9 99 99 99 99|99.99.99.99.99|99 99 99 99 99|+99 99 9999-9999|0800 999 9999|(99) 99999-9999|(99) 9999-9999|999-999-9999"
).split("|")
IDS = {
    "ja": "個人番号 9999 9999 9999|個人番号:999999999999|基礎年金番号 9999-999999|旅券番号 AA9999999|マイナンバー 9999-9999-9999|運転免許証番号 999999999999".split("|"),
    "zh": "公民身份号码:999999 99999999 9999|身份证号 999999999999999999|身份证号 99999999999999999X|护照号 A99999999|公民身份号码:99999999999999999X|社保号 9999999999".split("|"),
    "ko": "주민등록번호 9999999999999|주민번호 999999 - 9999999|주민등록번호 999999-9999999|여권번호 A99999999|~999999-9999999|~999999 - 9999999|외국인등록번호 999999-9999999".split("|"),
    "en": "SSN 999-99-9999|social security number 999999999|social security number 999-99-9999|passport no. A99999999|passport no. 999999999|tax identification number 999-99-9999|tax identification number 999999999|TIN 99-9999999|national insurance number AA 99 99 99 A|~999-99-9999".split("|"),
    "fr": "n° de sécurité sociale 9 99 99 99 999 999 99|NIR 9999999999999|NIR 999999999999999|passeport n° 99AA99999|numéro fiscal 99 99 999 999 999".split("|"),
    "pt": "CPF 999.999.999-99|CPF nº 99999999999|CPF nº 999.999.999-99|RG 99.999.999-9|RG 99.999.999-X|passaporte nº AA999999|PIS 999.99999.99-9|~999.999.999-99".split("|"),
}
#: Addresses: 9 any digit, T a town, S a street or quarter, both made by rule.
ADDRESSES = {
    "ja": "〒999-9999 T県T市S町9丁目99番9号|T県T市S町9丁目9番9号|〒999-9999 T県T市S9-99-9|T県T市S町999番地|T県T市S9-9-99|〒999-9999 東京都T区S9丁目9番9号|大阪府T市S町9-9-9|S町9丁目9番9号|T県T市S台99-9-9|〒999-9999 T府T市S町99番地の9|北海道T市S9条9丁目9番99号|T県T郡T町S999番地9".split("|"),
    "zh": "T省T市T区S路99号9栋999室|T省T市T区S街999号|T区S路99号99层|T区S大道999号9层|北京市T区S大街99号|上海市T区S路999号9层|T区S街999号|T省T市T区S大道99号|T市S路999弄99号999室|T省T县S镇S路9号".split("|"),
    "ko": "T광역시 T구 S길 999-9 (S동)|T도 T시 S대로 999|T도 T시 S길 99-9, 9층|T특별시 T구 S대로 99, 99층|서울특별시 T구 S대로 999|T시 T구 S길 999-99 (S동)|T구 S대로 99|T도 T시 S로99번길 999|T광역시 T구 S로9번길 99-9 (S동)|T도 T군 S면 S로 999, 999호".split("|"),
    "en": "999 S Street, T|99 S S Street|999 S Road, Suite 999|999 S Street, Port T|999 S Ave., Suite 999|99 S S Lane, T ZZ9 9QQ|999 S St, T|999 S Blvd, T|99 S Road, T ZZ9 9QQ|9999 S Street, Suite 99|99 S Drive|999 S S Way, Floor 9|99a S Court, T|9 Old S Street|999 S Line Road, New T".split("|"),
    "fr": "999 bis, avenue du S à T|999, rue des S, 99999 T|99, quai de la S, 99999 Saint-T|999, quai de la S|999, rue des S-S|99 bis, avenue du S, 99999 T|99, boulevard S, 99999 T|9, impasse du S|99 ter, place de la S à T|99, chemin des S, 99999 T".split("|"),
    "pt": "Rua das S S, 999, sala 99|Av. S S, 999, Vila T|Travessa do S S, 999, Vila T|Rua das S S, 999 - CEP 99999-999|Rua dos S, 999|Av. S, 999 - CEP 99999-999|Travessa da S, 999|Avenida S, 9999, sala 99|Praça S S, 999, conj. 99|Alameda dos S, 99, T|Rodovia S, 999, T".split("|"),
}
ENDS = "example test invalid com co.jp org net com.br fr co.kr".split()
#: Sentences that hold what is looked for: N name, P phone, I number of a person, A address, E email address.
PERSONAL = {
    "ja": "連絡担当は経理部長 {N}。|代表者の役職氏名は代表取締役社長{N}である。|代表者の役職氏名は代表取締役社長 {N}である。|{N}氏は社外取締役に再任された。|提出者:{N}|届出書に{I}とある。|保証人の{I}が記載されている。|電話番号は{P}である。|TEL:{P}|連絡先 {P}(平日のみ)。|書類の送付先:{A}|本店の所在の場所は{A}である。|売却した土地は{A}に所在する。|資料の請求先は{E}である。|電子メール:{E}|問い合わせは{E}まで。|{N}|{P}|{A}|{E}|{I}|担当者 {N}様|監査役{N}が署名した。",
    "zh": "独立董事{N}先生连任。|法定代表人为{N}。|签字会计师{N}出具意见。|联系人:{N}|联系人:{N}。|申报表载有{I}。|{I}|电话:{P}|联系电话{P}。|查询可拨打{P}。|注册地址为{A}。|寄送地址:{A}|资料存放于{A}。|查询请寄{E}。|邮箱:{E}|{N}|{P}|{A}|{E}|董事长{N}女士辞任。|保证人的{I}已登记。",
    "ko": "대표이사 {N}.|작성책임자는 {N} 부장이다.|사외이사로 {N} 씨가 재선임되었다.|신고서에 {I} 로 기재되어 있다.|보증인의 신분 사항은 {I} 이다.|전화번호는 {P}이다.|연락처 {P} 평일 근무시간.|(전화) {P}|{N}|본점 소재지는 {A}이다.|매각 토지는 {A} 에 있다.|자료 요청처 {E}.|전자우편: {E}|문의는 {E} 으로 한다.|{N}|{P}|{A}|{E}|{I}|담당 {N} 과장|서류 보낼 곳: {A}|우편물은 {A} 로 보낸다.",
    "en": "Signed by {N}, Chief Financial Officer.|According to Dr. {N}, the method is unchanged.|The inquiry desk is headed by Ms. {N}.|{N} was re-elected as outside director.|Mr. {N} was re-elected as outside director.|The form quotes {I} for the seller.|Identification on file: {I}.|The pledge lists the guarantor's {I}.|Telephone {P}.|Tel: {P}|Call {P} for paper copies.|The desk can be reached on {P} on weekdays.|Send forms to {A}.|Documents are kept at {A}.|The lot sold lies at {A}.|Registered office: {A}|Questions may be sent to {E}.|Contact: {E}|Write to {E}.|(mail: {E})|{N}|{P}|{A}|{E}|{I}|Contact: {N}|Attn: {N}|Audit partner: {N}",
    "fr": "Mme {N} a été réélue administratrice.|M. {N} a été réélu administrateur.|Signé par {N}, directeur financier.|Contact : {N}.|Contact : {N}|La garante a fourni son {I}.|Le formulaire mentionne {I}.|Tél. {P}|Le numéro de téléphone est {P}.|Joindre le service au {P}.|Le numéro est le {P}.|Adresse : {A}|Le siège se situe au {A}.|Le terrain vendu se trouve au {A}.|Courriel : {E}|Les questions sont à adresser à {E}.|{N}|{P}|{A}|{E}|{I}|Écrire à {E}.",
    "pt": "Assinado por {N}.|A conselheira {N} foi reeleita.|Diretor responsável: {N}.|Consta no formulário {I}.|O fiador informou {I}.|O telefone é {P}.|Fone: {P}|A sede fica na {A}.|Endereço: {A}|O terreno vendido fica na {A}.|E-mail: {E}|Dúvidas devem ser enviadas a {E}.|{N}|{P}|{A}|{E}|{I}|Contato: {N}",
}
#: Sentences that hold none of it. C company, L place, T line of business, # figures.
PLAIN = {
    "ja": "{L}の工場は第99期に完成した。|法人番号は9999999999999である。|受付番号99999999999999により提出した。|型番KS-9999-9999の販売を終えた。|9999-9999-9999年度の数値を修正した。|9999999999|注記99-99-9999を参照。|証券コード9999の{C}は上場している。|{C}向けの売上は全体の99.9%で、9999年の99.9%と比べて縮小した。|{L}の売掛金について減損損失#千円を計上した。|第9四半期の{T}の受注は価格改定の浸透に伴い、99.9%後退した。|{C}は当社の議決権の99.9%を保有している。|{T}に関して9999年から9999年までに#百万円の投資を見込んでいる。|{L}周辺の{T}の需要は9999年まで年率99.9%で伸びる見通しである。|9999年9月、{C}との{T}の供給契約を999か月延長した。|営業利益は#億円で、前期の999.9億円から低迷した。|{L}では999名が勤務し、年間#個を出荷した。|割引率が一ポイント動いた場合、売掛金は約#千円変動する。|為替は{T}の収入を#億円押し上げたが、数量は99.9%縮小した。|実効税率は暖冬の影響から99.9%となり、99.9ポイント上昇した。|減価償却費#千円の多くは9999年に導入した{T}の設備に係る。|投資活動に用いた資金は#億円で、このうち#百万円を{T}に充てた。|一株当たり99.9円の配当を提案し、配当性向は99.9%である。|{L}が一か月停止した場合、売上高は#億円減る可能性がある。|第9四半期に自己の株式#株を#億円で取得した。|資料はhttps://ir.{H}/9999にある。|社債は@99.9で発行した。|代表取締役社長の選任を決議した。|社外取締役は3名である。|{T}事業の売上高は補助金の終了を受けて、前期比99.9%の#億円となり、増加した。|9999年9月末における繰延税金資産の残高は#億円である。|主要な株主|従業員の状況|役員の氏名は別紙による。",
    "zh": "{L}的厂区于第99期完工。|统一信用代码为9999999999999999ZZ。|公告编号9999-9999。|参见附注99-99-9999。|型号KS-9999-9999停产。|9999-9999-9999年度数据已重述。|证券代码999999。|对{C}的销售占收入的99.9%,而9999年为99.9%,有所下降。|公司对{L}的商誉计提减值#千元。|第9季度{T}订单变动99.9%,因产品结构变化,明显减少。|{C}持有公司99.9%的表决权。|公司计划在9999年至9999年间向{T}投入#元。|预计到9999年{L}周边{T}需求年均增长99.9%。|9999年9月,公司与{C}将{T}供货合同延长999个月。|营业利润由上年的#千元变为#亿元,略有回落。|{L}共有员工999人,全年发货#件。|折现率变动一个百分点,应收账款将变动约#万元。|汇率使{T}收入增加#千元,而销量变动99.9%,有所下降。|受两座工厂复产影响,实际税率为9.9%,变动99.9个百分点,同比提高。|折旧#万元主要来自9999年安装的{T}设备。|投资活动支出#万元,其中#亿元用于{T}。|拟每股派息99.9元,派息率为99.9%。|若{L}停工一个月,收入可能减少#千元。|第9季度公司以#千元回购股份#股。|资料见https://ir.{H}/9999。|债券以@99.9发行。|独立董事共三名。|法定代表人未变更。|由于暖冬,{T}业务收入为#千元,变动99.9%,明显上升。|9999年9月末,预计负债余额为999.9万元。|主要股东|风险提示",
    "ko": "법인등록번호는 999999-9999999이다.|접수번호 99999999999999로 제출하였다.|주석 99-99-9999를 참조한다.|모델 KS-9999-9999 판매를 종료하였다.|9999-9999-9999 회계연도를 재작성하였다.|{C}에 대한 매출은 전체의 99.9%로 9999년의 99.9%에 비하여 줄어들었다.|{L}의 매출채권에 대하여 손상차손 #천원을 인식하였다.|9분기 {T} 수주는 온화한 겨울의 영향으로 99.9% 둔화되었다.|{C}는 회사 의결권의 99.9%를 보유하고 있다.|{T}에 9999년부터 9999년까지 #천원을 투자할 계획이다.|{L} 주변 {T} 수요는 9999년까지 연 99.9% 성장할 전망이다.|9999년 9월 {C}와 {T} 공급 계약을 999개월 연장하였다.|영업이익은 #억원으로 전기의 #천원에서 감소하였다.|{L}에는 999명이 근무하며 연간 #개를 출하하였다.|할인율이 일 포인트 변동하면 리스부채은 약 #백만원 변동한다.|환율은 {T} 수익을 #억원 높였으나 물량은 99.9% 둔화되었다.|유효세율은 보조금 종료로 99.9%로 99.9포인트 확대되었다.|감가상각비 #억원은 대부분 9999년에 설치한 {T} 설비에서 발생하였다.|투자활동에 사용한 현금은 #억원이며 이 중 #억원은 {T}에 사용되었다.|주당 99.9원의 배당을 제안하며 배당성향은 99.9%이다.|{L}이 한 달간 중단되면 매출이 #억원 감소할 수 있다.|9분기에 자기주식 #주를 #억원에 취득하였다.|자료는 https://ir.{H}/9999 에 있다.|{L}의 공장은 99기에 완공되었다.|대표이사 변경은 없다.|{T} 부문의 매출액은 일부 수주의 이월로 전기 대비 99.9% 변동한 999.9억원으로 개선되었다.|9999년 9월 말 매출채권 잔액은 #백만원이다.|{T} 연구비는 #천원으로 매출의 99.9%에 해당한다.|배당 정책|임직원 현황|작성책임자는 미정이다.",
    "en": "Corporate number 9999999999999 applies to the group.|Receipt number 99999999999999 was issued for the filing.|The ISIN-like code ZZ9999999999 refers to the bond.|See note 99-99-9999.|Model KS-9999-9999 was withdrawn.|Fiscal years 9999-9999-9999 are restated in the tables.|Lot 999-999-99 was sold.|Order 9999999999 was shipped.|Bonds were placed @ 99.9.|Sales to {C} made up 99.9% of revenue, compared with 99.9% in 9999.|An impairment loss of USD # billion was booked on goodwill at {L}.|Orders for {T} slipped 9.9% in the first quarter, in spite of a strike at the port.|{C} holds 99.9% of the voting rights of the company.|We plan to spend INR # million on {T} at {L} between 9999 and 9999.|We expect {T} demand around {L} to grow 99.9% a year until 9999.|The company and {C} agreed in September 9999 to extend the {T} supply contract for 999 months.|Operating profit in the {T} business went down to JPY # thousand from JPY # million a year earlier.|The {L} site employed 999 people and shipped # units in the year.|A one-point change in the discount rate would move goodwill by about EUR # billion.|Foreign exchange lifted {T} revenue by USD # thousand while volumes weakened 99.9%.|The effective tax rate went up by 99.9 points to 9.9%, as two plants resumed full operation.|Depreciation of JPY # thousand relates mostly to {T} equipment installed in 9999.|Cash used in investing activities was EUR # million, of which EUR # thousand went into {T}.|The board proposes a dividend of 99.9 per share, a payout of 99.9%.|If the {L} depot were closed for a month, revenue could fall by INR # thousand.|During the first quarter the company bought back # shares for USD # million.|Net sales of {T} grew 99.9% to USD # billion, on the back of replacement demand.|In May 9999 a claim of JPY # over {T} deliveries at {L} was settled out of court.|Documents are at https://ir.{H}/9999.|At the end of March 9999, inventories stood at INR # thousand, against INR # thousand at the previous year-end.|Major Shareholders|Results of Operations|Legal Proceedings|Subsequent Events|Corporate Governance|Risk Factors|Dividend Policy|Tax Matters|Capital Expenditure|Segment Information|Business Overview|Related Party Transactions|Research and Development|Employees|{L} Town|The director was re-elected.|Research spending on {T} came to EUR 999.9 million, or 99.9% of sales.",
    "fr": "Numéro SIREN 999 999 999.|Dépôt n° 99999999999999.|Voir note 99-99-9999.|Le modèle KS-9999-9999 est retiré.|Les exercices 9999-9999-9999 sont retraités.|Obligations émises @ 99.9.|Les ventes à {C} représentent 99.9% du total, contre 99.9% en 9999.|Une dépréciation de # milliards d'euros a été constatée sur le poste stocks à {L}.|{C} détient 99.9% des droits de vote.|Le groupe prévoit d'investir # millions d'euros dans l'activité {T} entre 9999 et 9999.|Autour de {L}, la demande de {T} devrait croître de 99.9 % par an jusqu'en 9999.|En 9/9999, le contrat conclu avec {C} a été prolongé de 999 mois.|Le site de {L} emploie 999 personnes et a expédié # unités.|L'activité {T} s'est accrue de 99.9% et atteint # milliards d'euros, avec la fin des aides à l'isolation.|L'amortissement de # milliards d'euros concerne surtout le matériel de {T} installé en 9999.|Au trimestre 9, # actions ont été rachetées pour # milliards d'euros.|Le dividende proposé est de 99.9 par action, soit un taux de 99.9%.|Fin 9/9999, le poste créances clients s'élevait à # millions d'euros.|La recherche liée à l'activité {T} a coûté # milliards d'euros, soit 99.9 % des ventes.|Documents : https://ir.{H}/9999|La marge opérationnelle est retombée à # milliards d'euros contre # milliards d'euros un an plus tôt.|Parties liées|Actionnaires|Politique de dividende|Litiges|Information sectorielle|Impôts|Effectifs|Gouvernement d'entreprise|Facteurs de risque",
    "pt": "CNPJ 99.999.999/0001-99 é o da companhia.|Protocolo 99999999999999.|Ver nota 99-99-9999.|O modelo KS-9999-9999 saiu de linha.|Os exercícios 9999-9999-9999 foram reapresentados.|Debêntures emitidas @ 99.9.|As vendas para {C} somaram 99.9% do total, ante 99.9% em 9999.|Foi reconhecida perda de # mil de reais na conta estoques em {L}.|{C} detém 99.9% dos votos.|A companhia planeja investir # milhões de reais em {T} entre 9999 e 9999.|Perto de {L}, a demanda por {T} deve crescer 99.9% ao ano até 9999.|Em 9/9999 o contrato com {C} foi prorrogado por 999 meses.|A unidade de {L} emprega 999 pessoas e expediu # peças.|A receita de {T} cresceu 99.9% e chegou a # milhões de reais, em função do mix de produtos.|A depreciação de # milhões de reais refere-se ao equipamento de {T} instalado em 9999.|No trimestre 9 foram recompradas # ações por # bilhões de reais.|Propõe-se dividendo de 99.9 por ação, payout de 99.9% do lucro.|Ao fim de 9/9999, a conta contas a receber somava # milhões de reais.|A pesquisa em {T} custou # mil de reais, ou 99.9% das vendas.|Uma variação de um ponto na taxa mudaria a conta ágio em # mil de reais.|Documentos em https://ir.{H}/9999.|O lucro operacional caiu para # bilhões de reais, ante # mil de reais no ano anterior.|Partes relacionadas|Capital e dividendos|Fatores de Risco|Eventos Subsequentes|Governança Corporativa|Política de Dividendos|Visão Geral|Empregados|Litígios",
}
#: Companies and places: S a word made by rule.
COMPANIES = {
    "ja": "S精機株式会社|S化成株式会社|S物流株式会社|S食品株式会社|S製作所株式会社|Sホールディングス株式会社|株式会社S|S電機工業株式会社|S商事株式会社|有限会社S|S建設株式会社|S薬品株式会社|S鉄道株式会社".split("|"),
    "zh": "S食品股份有限公司|S化工股份有限公司|S物流股份有限公司|S精机股份有限公司|S实业股份有限公司|S科技有限公司|S电子股份有限公司|S药业有限公司|S置业集团".split("|"),
    "ko": "S 산업 주식회사|S화학 주식회사|S물류 주식회사|S식품 주식회사|S정공 주식회사|S홀딩스 주식회사|주식회사 S|S전자 주식회사|S건설 주식회사|S제약 주식회사".split("|"),
    "en": "S Group plc|S Holdings plc|S Partners Corp.|S Materials Inc.|S Logistics Limited|S Industries Ltd.|S Foods Ltd.|S S Group plc|S S Corp.|S Energy Inc.|S Bank plc|S Systems LLC|S & S Limited|S Pharma Ltd.|S S Holdings plc|S S Materials Inc.|S S Industries Ltd.|S S Foods Ltd.|S S Logistics Limited|S S Partners Corp.|S-S Group plc|S-S S-S Holdings plc|S S-S Foods Ltd.|S-S Logistics Limited|S S Energy Inc.".split("|"),
    "fr": "S Holding SE|S Industries SA|S Matériaux SA|S Agro SA|S Logistique SAS|S S SA|Groupe S|S Énergie SAS|S-S Industries SA".split("|"),
    "pt": "S Alimentos S.A.|S Materiais S.A.|S Logística S.A.|S Indústrias S.A.|S S Energia S.A.|Banco S S.A.|S Papel Ltda.|S S Alimentos S.A.|S S Materiais S.A.|S S Logística S.A.|S S Indústrias S.A.".split("|"),
}
PLACES = {
    "ja": "S県S市|S事業所|S工場|S台地区|Sヶ里|S市|S町|S支店|S物流センター|S港".split("|"),
    "zh": "S港|S码头|S物流园|S园区|S镇|S省S市|S县|S新区|S基地|S工厂".split("|"),
    "ko": "S군|S 공장|S구|S 물류센터|S항|S공단|S단지|S 사업장|S읍|S시|S 지점|S 물류센터|S 공장|S 사업장".split("|"),
    "en": "S|Port S|S Point|S Bay|Sford|Sfield|S Valley|North S|S Harbour|Sville".split("|"),
    "fr": "S|S-Grise|Saint-S|S-sur-S|Sville|Port-S".split("|"),
    "pt": "Vila S|Porto S|Campo S|Pedra S|São S do Lago|Ribeirão S|Monte S|S|S Novo|Santa S".split("|"),
}
TRADES = {
    "ja": "産業用ポンプ 種苗販売 水処理装置 車両リース 連絡船 繊維加工 感知器 紙管 茶飲料".split(),
    "zh": "室内装修 粮食装卸 水处理设备 起重机出租 电池隔膜 瓶装茶 车辆租赁".split(),
    "ko": "감지 모듈|산업용 펌프|종자 판매|완구 라이선스|차량 임대|유리 섬유|지관".split("|"),
    "en": "timber frames|crane rental|toy licensing|bottled tea|glass fibre|paper tubes|packaging films".split("|"),
    "fr": "pompes industrielles|peintures marines|tubes en carton|pièces moulées|négoce de semences".split("|"),
    "pt": "fundição de precisão|tintas navais|comércio de sementes|tratamento de água".split("|"),
}
#: Lines of business made by rule.
TRADES_BY_RULE = {
    "ja": "S事業 Sサービス S機器 S部材 S輸送 S材料 S用品 S管理".split(),
    "zh": "S服务 S设备 S贸易 S加工 S运输 S材料 S制造 S产品".split(),
    "ko": "S 서비스|S 장비|S 무역|S 가공|S 운송|S 부품|S 재료".split("|"),
    "en": "s services|s equipment|s trading|s products|s parts|s works".split("|"),
    "fr": "services de s|matériel de s|négoce de s|pièces de s".split("|"),
    "pt": "serviços de s|comércio de s|peças de s|produtos de s".split("|"),
}
#: Bare words of tables and headings.
ITEMS = {
    "ja": "棚卸資産 売掛金 のれん 自己株式 契約負債 短期借入金 無形固定資産 建設仮勘定 繰延税金資産 退職給付引当金 リース債務 製品保証引当金 項目 当期 前期 研究の状況 設備の状況 訴訟の状況 配当の考え方 統治の体制 後発の事象 建機賃貸 冷蔵倉庫 穀物荷役 船舶塗料 玩具版権 内装工事 給食受託 歯科材料 硝子繊維 精密鋳造 鉄道信号 駐車場運営 資金の状況 事業の概要".split(),
    "zh": "库存股 存货 商誉 应收账款 合同负债 短期借款 无形资产 在建工程 递延所得税资产 预计负债 租赁负债 退休福利准备 质量保证准备 项目 本期 上期 种子贸易 织物整理 齿科材料 轨道信号 精密铸件 玩具授权 玻璃纤维 木结构件 冷链仓储 停车场运营 工业泵 包装薄膜 船舶涂料 关联交易 研发活动 公司治理 期后事项 资本支出 业务概况 诉讼事项 股利政策 分部信息 税务事项 员工情况".split(),
    "ko": "자기주식|재고자산|영업권|매출채권|계약부채|단기차입금|무형자산|건설중인자산|이연법인세자산|판매보증충당부채|퇴직급여충당부채|리스부채|구분|당기|전기|지배구조|위험 요인|소송 현황|세무 사항|설비 투자|자금의 현황|부문별 정보|사업의 개요|주주의 현황|정밀 주조|포장 필름|섬유 가공|치과 재료|곡물 하역|냉장 창고|철도 신호|실내 공사|주차장 운영|수처리 설비|급식 위탁|차 음료".split("|"),
    "en": "inventories|goodwill|treasury shares|trade receivables|contract liabilities|short-term borrowings|intangible assets|construction in progress|deferred tax assets|lease liabilities|warranty reserves|Item|Current|Prior|Results of Operations|Segment Information|Notes on Accounting Estimates|Liquidity and Capital Resources".split("|"),
    "fr": "stocks|écarts d'acquisition|créances clients|passifs sur contrats|impôts différés actifs|Poste|Exercice|Précédent|actions propres|Facteurs de risque|Parties liées".split("|"),
    "pt": "estoques|ágio|contas a receber|passivos de contrato|ações em tesouraria|Conta|Atual|Anterior|imobilizado em andamento|Fatores de risco".split("|"),
}
#: Headings made by rule.
HEADINGS_BY_RULE = {
    "ja": "Sの状況|Sの概要|Sの方針|Sに関する事項|S資産|S負債|S計画".split("|"),
    "zh": "S说明|S情况|S事项|S政策|S概况|S分析|S信息|S资产|S负债|S计划|S报告|S估计说明|S准备".split("|"),
    "ko": "S 현황|S 사항|S 정책|S의 개요|S 정보|S자산|S부채|S 계획".split("|"),
}
TYPES = {"N": "name", "P": "phone", "I": "id_number", "A": "address", "E": "email"}


def _digits(shape: str, r: random.Random) -> str:
    return "".join(r.choice("0123456789") if c == "9" else r.choice("ABCEKMQRTZ") if c == "A" and shape.count("A") <= 3 else c for c in shape)


def _figure(r: random.Random) -> str:
    return r.choice([f"{r.randint(1, 9)},{r.randint(100, 999)},{r.randint(100, 999)}", f"{r.randint(1000, 999999)}", f"{r.randint(100, 999)},{r.randint(100, 999)}", f"{r.randint(10, 999)},{r.randint(100, 999)},{r.randint(100, 999)}", f"{r.randint(1, 999)}.{r.randint(0, 9)}"])


def _invented(lang: str, r: random.Random, least: int = 2, most: int = 3) -> str:
    """A word that no list holds: characters, or syllables, at random."""
    if lang in PARTS:
        first, second = PARTS[lang]
        return "".join(r.choice(first or second) for _ in range(r.randint(least, most)))
    on, nucleus, coda = SYLLABLES[lang]
    return "".join(r.choice(on) + r.choice(nucleus) + r.choice(coda) for _ in range(r.randint(1, least))).capitalize()


def _surname(lang: str, r: random.Random) -> str:
    if r.random() < (0.25 if lang in ("ja", "en", "fr", "pt") else 0.7):
        return r.choice(SURNAMES[lang])
    if lang == "ja":
        return _invented(lang, r, 1, 3) if r.random() < 0.85 else f"{_invented(lang, r, 1, 1)}{r.choice('ヶノ')}{_invented(lang, r, 1, 1)}"
    if lang in ("zh", "ko"):
        return _invented(lang, r, r.choice([1, 2]), 2)
    s = _invented(lang, r)
    return f"{s}-{_invented(lang, r, 1)}" if r.random() < 0.12 else f"{s} {_invented(lang, r)}" if lang == "pt" and r.random() < 0.25 else s


def _given(lang: str, r: random.Random) -> str:
    if r.random() < 0.25:
        return r.choice(GIVEN[lang])
    if lang == "ja":
        return "".join(r.choice(PARTS["ja"][1]) for _ in range(r.choice([1, 2, 2, 3, 3])))
    if lang == "zh":
        return _invented(lang, r, 1, 2)
    if lang == "ko":
        return _invented(lang, r, 2, 3)
    g = _invented(lang, r)
    return f"{g}-{_invented(lang, r, 1)}" if lang == "fr" and r.random() < 0.15 else g


def _name(lang: str, r: random.Random) -> str:
    s, g = _surname(lang, r), _given(lang, r)
    if lang == "ja":
        return s + r.choice(["", " ", "\u3000"]) + g
    if lang in ("zh", "ko"):
        return s + g
    return r.choice([f"{g} {s}"] * 4 + [f"{g} {r.choice('ABCDEFGHJKLM')}. {s}"] * 2 + [f"{s.upper()} {g}", f"{s}, {g}"])


def _made(pattern: str, lang: str, r: random.Random) -> str:
    """A pattern of a company, place or address with its towns, streets and digits."""
    out = []
    for i, c in enumerate(pattern):
        inside = lang in SYLLABLES and (pattern[i + 1 : i + 2].islower() and not pattern[i + 1 :].startswith(("ford", "field", "ville")))
        if c in "TS" and not inside and not (i and pattern[i - 1 : i].isalpha() and lang in SYLLABLES) and not pattern[i:].startswith(("S.A", "SA", "SE", "SAS")):
            out.append(_invented(lang, r, 2, 3 if lang in PARTS else 2))
        else:
            out.append(r.choice("0123456789") if c == "9" else c)
    return "".join(out)


def _email(r: random.Random) -> str:
    g, s = (_given("en", r) for _ in range(2))
    user = r.choice([f"{g}.{s}".lower(), f"{g[0]}_{s}".lower(), f"ir{r.randint(1, 99)}", f"disclosure-{r.randint(1, 400)}", f"{g}+{r.choice(['tax', 'agm', 'ir'])}", s.lower(), "info", f"{g}{r.randint(1, 99)}".lower()])
    at = r.choice(["@"] * 6 + [" @ ", "＠", " (at) ", "[at]", " [at] ", "(at)"])
    host = f"{r.choice(['', '', 'ir.', 'mail.', 'docs.'])}{_invented('en', r).lower()}.{r.choice(ENDS)}"
    if "at" in at:
        host = host.replace(".", r.choice([" (dot) ", "[dot]", "."]))
    out = user + at + host
    return out.upper() if r.random() < 0.12 else out


def _wide(x: str) -> str:
    return "".join(chr(ord(c) + 0xFEE0) if c.isdigit() else c for c in x)


def _filled(template: str, lang: str, r: random.Random) -> list[tuple[str, str]]:
    """(text, type or empty) parts of one sentence."""
    out: list[tuple[str, str]] = []
    at = 0
    while at < len(template):
        c = template[at]
        if c == "{":
            k, at = template[at + 1], at + 3
            if k == "N":
                out.append((_name(lang, r), "name"))
            elif k == "P":
                p = _digits(r.choice(PHONES), r)
                out.append((_wide(p) if r.random() < 0.08 and lang in ("ja", "zh", "ko") else p, "phone"))
            elif k == "I":
                shape = r.choice(IDS[lang])
                first = next((i for i, ch in enumerate(shape) if ch == "9" or (ch == "A" and i + 1 < len(shape) and shape[i + 1] in "A9")), 0)
                label, number = shape[:first].lstrip("~"), shape[first:]
                out += [(label, ""), (_digits(number, r), "id_number")]
            elif k == "A":
                out.append((_made(r.choice(ADDRESSES[lang]), lang, r), "address"))
            elif k == "E":
                out.append((_email(r), "email"))
            elif k == "C":
                out.append((_made(r.choice(COMPANIES[lang]), lang, r), ""))
            elif k == "H":
                out.append((f"{_invented('en', r).lower()}.{r.choice(ENDS)}", ""))
            elif k == "W":
                out.append((_made(r.choice(HEADINGS_BY_RULE[lang]), lang, r) if lang in PARTS and r.random() < 0.35 else r.choice(ITEMS[lang]), ""))
            elif k == "L":
                out.append((_made(r.choice(PLACES[lang]), lang, r), ""))
            else:
                made = r.choice(TRADES_BY_RULE[lang])
                made = made.replace("S", _invented(lang, r)) if lang in PARTS else "".join(w if w != "s" else _invented(lang, r).lower() for w in re.split(r"\b", made))
                out.append((r.choice([*TRADES[lang], made, made, made]), ""))
            continue
        out.append((_figure(r) if c == "#" else r.choice("0123456789") if c == "9" else c, ""))
        at += 1
    return out


def labelled(n: int = 10000, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """n labelled lines (the bound of the training sample): text and (start, end, type) of what it holds."""
    r, out = random.Random(seed), []
    plain = {k: [*v.split("|"), "{W}", "{W}", "{W}", "{L}", "{L}", "{T}", "{C}", "| {W} | # |", "| {W} | # | (#) |", "| {W} | (#) | # |", "| {W} | - | (#) |", "| {W} | △# | # |"] for k, v in PLAIN.items()}
    personal = {k: v.split("|") for k, v in PERSONAL.items()}
    for k, v in personal.items():
        v += ["{N}"] * (8 if k in PARTS else 4)
    for _ in range(n):
        parts: list[tuple[str, str]] = []
        lang = r.choice(list(PLAIN))
        if r.random() < 0.25:  # a row of a table
            for _ in range(r.randint(1, 3)):
                parts += [("| ", ""), *_filled(r.choice(["{N}", "{N}", "{N}", "{P}", "{A}", "{E}", "{I}", "{L}", "{C}", "{T}", "{W}", "{W}", "#", "△#", "(#)", "-", "---"]), lang, r), (" ", "")]
            parts.append(("|", ""))
            if r.random() < 0.5:
                parts += _filled(r.choice(plain[lang]), lang, r)
        else:
            for _ in range(r.choice([1, 1, 2])):
                table = personal if r.random() < 0.55 else plain
                parts += [(r.choice(["", "", "", "## ", "- ", "xxxxxxxx ", "* "]) if not parts else r.choice(["", " ", " "]), ""), *_filled(r.choice(table[lang if r.random() < 0.9 else r.choice(list(PLAIN))]), lang, r)]
        text, spans = "", []
        for t, k in parts:
            if k:
                spans.append((len(text), len(text) + len(t), k))
            text += t
        out.append((text, spans))
    return out
