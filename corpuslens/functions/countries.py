"""Surname dictionary and surname patterns. Fixed values; their order is part of the meaning."""

# Surname -> country, looked up without case and accents; the first entry wins.
SURNAME_COUNTRY = (
    ("Hadzhikoleva", "Bulgaria"),
    ("Hadzhikolev", "Bulgaria"),
    ("Siraj", "Saudi Arabia"),
    ("Aidarus", "Somalia"),
    ("Ahmed", "Egypt"),
    ("Mohamed", "Egypt"),
    ("Alsulami", "Saudi Arabia"),
    ("Azhar", "Pakistan"),
    ("Jahan", "Bangladesh"),
    ("Begum", "Bangladesh"),
    ("CHIHA", "Algeria"),
    ("Anugula", "India"),
    ("Parthiban", "India"),
    ("Shetty", "India"),
    ("Indugu", "India"),
    ("Chakraborty", "India"),
    ("Karanjai", "India"),
    ("Kumar", "India"),
    ("Bansal", "India"),
    ("Arora", "India"),
    ("Tiwari", "India"),
    ("Thirunavukarasu", "India"),
    ("P", "India"),
    ("S", "India"),
    ("Mo", "China"),
    ("Zhong", "China"),
    ("Ran", "China"),
    ("Tang", "China"),
    ("Bai", "China"),
    ("Cao", "China"),
    ("Chen", "China"),
    ("Dongshuo", "China"),
    ("Fan", "China"),
    ("Guo", "China"),
    ("Huang", "China"),
    ("Jia", "China"),
    ("Li", "China"),
    ("Tian", "China"),
    ("Wei", "China"),
    ("Wu", "China"),
    ("Xuan", "Vietnam"),
    ("Zhang", "China"),
    ("Zhao", "China"),
    ("周", "China"),
    ("姜梓涵", "China"),
    ("翼", "China"),
    ("郭光玉", "China"),
    ("Jung", "South Korea"),
    ("Ng", "Malaysia"),
    ("Chan", "Malaysia"),
    ("Loo", "Malaysia"),
    ("Wijanto", "Indonesia"),
    ("Truong", "Vietnam"),
    ("Settewong", "Thailand"),
    ("Petrovic", "Serbia"),
    ("Petkovic", "Serbia"),
    ("Sanda", "Romania"),
    ("Artyukhov", "Russia"),
    ("Przybyszewski", "Poland"),
    ("Ungureanu", "Romania"),
    ("Pătruț", "Romania"),
    ("Sinav", "Turkey"),
    ("Kurt", "Turkey"),
    ("POLAT", "Turkey"),
    ("Karaoglan Yilmaz", "Turkey"),
    ("Nana", "Ghana"),
    ("Aguilar-Lopez", "Mexico"),
    ("Albán Cuestas", "Colombia"),
    ("Arista", "Peru"),
    ("Balart", "Cuba"),
    ("Beltre", "Dominican Republic"),
    ("Contreras-Medina", "Mexico"),
    ("Cornide-Reyes", "Chile"),
    ("Flores Portillo", "Mexico"),
    ("González-Bravo", "Mexico"),
    ("Kadel", "Nepal"),
    ("Ricoy", "Mexico"),
    ("Valdivia", "Chile"),
    ("XAVIER MUNIZ", "Brazil"),
    ("Di Lodovico", "Italy"),
    ("Ferrara", "Italy"),
    ("Melonis", "Italy"),
    ("Gomes", "Portugal"),
    ("Fleischmann", "Germany"),
    ("Schöning", "Germany"),
    ("Offerman", "Netherlands"),
    ("Bailey", "United Kingdom"),
    ("Burbage", "United Kingdom"),
    ("Chapman", "United Kingdom"),
    ("Hider", "United Kingdom"),
    ("Meakin", "United Kingdom"),
    ("Smith-McCallister", "United States"),
    ("Steel", "United Kingdom"),
    ("إيمان", "Egypt"),
    ("حسن", "Egypt"),
    ("علي", "Egypt"),
)

# Ordered (pattern, country) rules on the unfolded surname, case-insensitive.
SURNAME_PATTERNS = (
    (r"[\x{0600}-\x{06FF}]", "Egypt"),
    (r"[\x{4E00}-\x{9FFF}\x{3040}-\x{30FF}\x{AC00}-\x{D7AF}]", "China"),
    (r"(ov|ova|ev|eva|ic|ić|ski|ska|czyk|enko|yk)$", "Russia"),
    (r"(oğlu|oglu|yılmaz|yilmaz|çelik|celik|kaya|demir|şahin|sahin)$", "Turkey"),
    (r"(swamy|swami|krishna|rajan|kumar|nair|rao|reddy|iyer|naidu|patel|sharma|gupta|singh|jain|mehta|malhotra|bose|ghosh|das|dutta|mukherjee|chatterjee|banerjee|roy|sen|paul|bhat|kaur|soni|verma|mishra|pandey|trivedi|joshi|dubey|aggarwal|agarwal|kapoor|saxena|srivastava|shukla|bajpai|yadav|tiwari|chaturvedi)$", "India"),
    (r"^(wang|liu|zhang|chen|yang|huang|zhao|wu|zhou|xu|sun|ma|zhu|hu|lin|guo|he|luo|gao|zheng|tang|liang|xie|yao|wei|han|xu|feng|deng|cao|peng|zeng|xiao|tian|ding|shao|fang|shi|yan|dong|fan|cheng|bai|jia|ren|mao|qian|zou|wu|shen|lu|liao|jiang|lei|dai|yin|mo|fu|pang|xue|xiong|ou)$", "China"),
    (r"^(nguyen|tran|le|pham|hoang|phan|vu|dang|bui|do|ho|ngo|duong|ly|truong|dinh|ta|luong|mai|luu|dao|trinh|phu|huynh)$", "Vietnam"),
    (r"^(kim|lee|park|choi|jung|kang|cho|yoon|jang|lim|han|oh|shin|kwon|hong|seo|yang|ko|moon|son|chun|bae|ahn|ryu|jeon|ha|kwak|cha|nam|yoo|joo|chun|baek)$", "South Korea"),
    (r"^(tanaka|suzuki|sato|watanabe|ito|yamamoto|nakamura|kobayashi|kato|yoshida|yamada|sasaki|yamaguchi|matsumoto|inoue|kimura|hayashi|shimizu|yamazaki|mori|ikeda|hashimoto|yamashita|ishikawa|nakajima|fujita|ogawa|goto|ota|hasegawa|maeda|fujii|nishimura|murakami)$", "Japan"),
    (r"(bin|binti|ahmad|mohd|abd|abdul|ismail|hassan|ibrahim|rahman|rahim|razak|aziz|osman|omar|ali|hamid|kadir|jamal|latif|amin)$", "Malaysia"),
    (r"(wong|wong|suporn|siri|chai|porn|rat|nok|sri|suk|nut|pong|nat|yada)$", "Thailand"),
    (r"(ez|oz|az|iz|ez|ón|os|as)([-\s]|$)", "Mexico"),
    (r"(andez|andez|uez|iez|aez)([-\s]|$)", "Spain"),
    (r"(eira|eiro|inho|inha|ões|ção|são|ão)$", "Brazil"),
    (r"(elli|etti|ini|oni|ino|ino|elli|ati|ati|ari|ori|eri|ieri|ucci|acci|icci)([-\s]|$)", "Italy"),
    (r"(mann|berg|burg|stein|feld|bach|haus|dorf|hagen|brandt|schmidt|schneider|müller|muller|bauer|schäfer|schaefer|hoffmann|krause|richter|klein|wolf|lange|lehmann|neumann|schulz|maier|meyer|becker|fischer|braun|herrmann|koehler|hartmann|zimmermann|kramer|kruger|vogel|roth|mayer|hahn|kaiser|weiss|otto|schwarze)([-\s]|$)", "Germany"),
    (r"(ov|ova|ev|eva|enko|chuk|sky|ski|ska|chy|ich)([-\s]|$)", "Russia"),
    (r"(ski|ska|cki|cka|wski|wska|czyk|iak|ak|ek|nik)([-\s]|$)", "Poland"),
    (r"(escu|eanu|anu|aru|aru|iu|ean|ean)([-\s]|$)", "Romania"),
    (r"(opoulos|oulos|akis|idis|ides|aris|aris|as|is)([-\s]|$)", "Greece"),
    (r"(eau|ault|ois|ois|ard|ier|ier|el|et)([-\s]|$)", "France"),
    (r"(sen|ssen|son|sson|berg|dahl|dal|vik|land|lund|strom|ström|bjorn|bjørn)([-\s]|$)", "Sweden"),
    (r"(obi|nna|eze|chi|ike|ade|ola|wale|emeka|chukwu|uche|nkem|tunde|babatunde|akin|bello|ibrahim|musa|lawal|yusuf|abdullahi|aliyu|usman|adamu|sani)([-\s]|$)", "Nigeria"),
)

UNKNOWN_COUNTRY = "Unknown"
DEFAULT_COUNTRY = "United States"
