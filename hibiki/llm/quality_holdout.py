"""Hand-checked texts for the calibration of problem 9: (text, is natural prose).

All content is invented. They are kept out of training as long as a corpus has
documents of both kinds.
"""

PROSE = [
    "The rain had stopped before dawn, and nobody in the house had noticed. Mara opened the window and listened to the gutters.\nShe did not think of the letter until noon.",
    "“You are late,” said the porter.\n“I know.”\nHe took the key from its hook and pushed it over the counter without another word.",
    "I read this chapter twice. The scene at the pier works well, but the last paragraph hurries; it could use another sentence or two.",
    "雨は夜明け前に止んでいた。誰も気づかなかった。真理は窓を開けて、樋の音を聞いていた。",
    "「遅かったね」\n「ごめん」\n彼は鍵を取って、何も言わずに机の上に置いた。",
    "この章はとても良かったです。特に最後の場面が好きで、何度も読み返しました。続きを楽しみにしています。",
    "When the train reached the valley, most of the passengers were\nasleep. Only the boy at the end of the carriage was looking\nout, counting the lights of the farms, and he told no one what\nhe had seen.",
    "Translator's note. The pun in the second line cannot be kept. I have chosen a phrase of like tone, though it loses the joke about the well.",
    "## Notes on chapter 12\n\nThe old man never answers the question. He only laughs and pours the tea, and so the reader has to decide.",
    "Thank you!",
    "彼女は駅前の店で小さな鏡を買った。帰り道、それを落としてしまった。けれど割れていなかった。",
    "Nothing moved on the square. A dog slept in the shade of the fountain, and even the flags hung still. It was too hot to talk.",
    "“Wait.”\n“For what?”\n“For me!”",
    "先生は黙って頷いた。それから窓の外を指差して、「もう春だね」と言った。",
    "My grandmother kept the recipe in a tin under the stairs. She said that it was for bread, but it was not. It was a map, and it took us three summers to read it.\n- flour\n- salt",
]
JUNK = [
    "- flour\n- salt\n- yeast\n- two eggs\n- a tin of milk",
    "1. The pier at dawn ... 12\n2. The porter's key ... 31\n3. The valley ... 58\n4. The fountain ... 77",
    "1. Mara opened the window and listened.\n2. The porter pushed the key over the counter.\n3. Nobody had noticed the rain.",
    "| Word | Meaning | Seen |\n|---|---|---|\n| 樋 | gutter | 2 |\n| 鍵 | key | 5 |\n| 窓 | window | — |",
    "id,jp,en,score\n0,\"雨は止んでいた。\",\"The rain had stopped.\",0.81\n1,\"彼は鍵を取った。\",\"He took the key.\",0.77",
    "part\tmodel\tscore\npart_001\talpha\t0.31\npart_002\tbeta\t0.99\npart_003\talpha\t0.15",
    "Home | Next | Previous | Log in | Table of Contents | Share | Reply | Next | Home",
    "12:01:33.120 WARN load[4] retry=2 code=0x1f3a\n12:01:35.002 WARN load[4] retry=3 code=0x1f3a",
    "[{\"part\": 3, \"ok\": true, \"v\": [0.1, 0.22, 0.9]}, {\"part\": 4, \"ok\": false, \"v\": [0.3, 0.1, 0.7]}]",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！！",
    "window rain key porter square dog shade flag valley farm light boy carriage tin map bread summer stairs recipe",
    "鏡 駅 店 窓 春 先生 鍵 机 雨 樋 夜明け 帰り道 茶 犬 噴水 旗",
    "・鏡\n・鍵\n・窓\n・春の雨\n・小さな机\n・噴水",
    "・彼は鍵を取った。\n・雨は止んでいた。\n・誰も気づかなかった。\n・先生は黙って頷いた。",
    "ã\x81\x82ã\x82\x81ã\x81¯å¤\x9cæ\x98\x8eã\x81\x91å\x89\x8dã\x81«",
    ">x{ &<<0@=+|;/x//x}>x< #0]0* [$x]^;0/$= *0|%> @{0*x<@;/\\<{ [",
    "Mara / pier\nPorter / counter\nBoy / carriage\nGrandmother / stairs",
    "# Rules\nthe old map\nthe small mirror\nthe tin of bread\nthe shade",
    "-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_-_",
    "樋｜雨｜12\n鍵｜机｜31\n窓｜春｜58",
    "Mara      120  14.20% ###\nPorter     88  10.01% ##\nBoy        31   3.40% #",
    "Part 1: The pier\nPart 2: The porter\nPart 3: The valley",
    "[001] Mara / pier\n[002] Boy / carriage\n[003] Porter / counter",
]
PROSE += [
    "He slept until the bell rang. Then he slept again.",
    "she never came back for the umbrella. it is still in the hall, next to the boots nobody wears.",
    "I liked this one less than the last. Too many names, and the storm came from nowhere.",
    "“Is it far?”\n“Not if we run.”\n“Then run.”",
    "The ferry was late. The captain blamed the tide, the cook blamed the captain, and the rest of us ate bread.",
    "Why does the narrator lie here? I went back to chapter three and found nothing that explains it.",
    "My translation keeps the present tense of the source. English readers may stumble, but the scene needs the haste.",
    "On the third day it snowed.\nOn the fourth the road was gone.\nWe counted the tins and said nothing.",
    "Nobody had told Ines about the dog. She opened the gate, and it was as if the whole yard jumped.",
    "Great chapter! I could not stop reading. Please let the old woman live.",
    "The clerk stamped the form twice, sighed, and stamped it again. “That should do,” she said.",
    "It was a small room with a large clock. Every quarter of an hour it struck, and every quarter of an hour my uncle looked up and forgot what he had been saying.",
    "Thanks for the quick update. The typo in the second scene is gone now.",
    "He wrote to her every week. She kept the letters in a drawer and answered none of them, but when he died she read them aloud to her children.",
    "    The pump broke in June.\n    By July we carried water from the river.\n    Nobody sang any more.",
    "A wind came up after supper and took the washing with it. They found a shirt in the orchard and another on the church roof.",
    "“I told you,” said Berta, “that the key is under the stone.”\nIt was not.\n“Then under the other stone.”",
    "There is a joke in the original that depends on two words which sound alike. I moved it to the next line, where English has a pair of its own.",
    "The old road runs along the ridge. Farmers use it still, though the bridge at its end fell before the war.",
    "I don't think he meant it. Did he?",
    "When the lights came back, the third chair was empty and the cards lay face down on the table, all but one.",
    "We waited. We waited some more. In the end the doctor came out and shook his head, and my father put on his hat.",
    "The review says that the ending is cruel. I disagree. It is honest, and that hurts more.",
    "Rain. Rain all week. The children drew boats on the window.",
    "At nine the baker opened his shutters; at ten past nine he had sold the last loaf, and he closed them again.",
    "The tone of the captain's speech is formal in the source. I used full forms and left out the oaths.",
    "She laughed until the tea was cold.\n\nThen she told him what the letter said, and he didn't laugh.",
    "For years the two brothers did not speak. What began with a fence ended with a wedding.",
    "It isn't a ghost story, though there is a ghost. It is a story about a house that nobody wants to sell.",
    "“Mother?”\n“Go to sleep.”\n“There's someone at the door.”\n“There is no door there, dear.”",
    "Between the barn and the creek lay a strip of land that belonged to no one. We played there until they built the mill.",
    "The narrator's sister appears once only, in the scene at the station. I suspect that she was cut from a longer draft.",
    "You can skip this chapter. Nothing happens in it, and it happens slowly.",
    "Three men carried the piano up the stairs. Four would have been better, as they found out on the landing.",
    "The sea was flat and grey. Gulls sat on it like stones. He rowed without looking round.",
    "no sound came from the cellar. he took the lamp and went down anyway, counting the steps as he had done when he was small.",
    "In the morning there were tracks around the hut. They came from the wood, went twice around the walls\nand ended at the window, and nothing led away from\nthem in any direction that we could\nfind.",
    "The lamp went out at the worst moment. Somebody swore, somebody giggled, and the dog sat down on my foot.",
    "I have kept the honorifics. They tell the reader who is angry with whom, and no English word does that as briefly.",
    "Grandfather never spoke of the mine. He kept his helmet on the shelf, and once a year he polished it.",
    "夜が明けるころ、犬が帰ってきた。足には泥がついていた。誰も叱らなかった。",
    "「もう寝たの」\n「まだ」\n「じゃあ、話をしよう」",
    "祖母は縁側で豆をむいていた。私は隣に座って、何も言わずに手伝った。",
    "今回の更新もありがとうございます。後半の会話が特に好きです。次回も待っています。",
    "雷が鳴った。灯りが消えた。それでも彼女は本を閉じなかった。",
    "The bees left in the second week of May. My aunt said that they knew something, and she was right.",
    "汽車は一時間遅れて着いた。迎えは来ていなかった。彼女は鞄を持ち直して、坂を上り始めた。",
    "訳注。この場面の冗談は音に頼っているので、別の言葉に置き換えた。意味は少し変わっている。",
    "海は静かだった。舟は動かなかった。老人は網を見つめたまま、長いこと黙っていた。",
    "「返してください」と少年は言った。男は笑って、帽子を川に投げた。",
    "雪は三日続いた。四日目の朝、屋根の上から弟が手を振った。",
    "どうして彼は手紙を燃やしたのだろう。私にはまだ分からない。",
    "　彼女は笑わなかった。\n　ただ、窓を少しだけ開けた。\n　春の匂いがした。",
    "隣の部屋で時計が鳴った。十二回数えて、それから眠った。",
    "この訳では敬語を残した。誰が誰に怒っているのか、それでよく分かるからだ。",
    "店の主人は首を振った。もう何年も前から、その茶碗は売り物ではないのだという。",
    "弟は走った。私も走った。けれど橋はもう流されていた。",
    "先週の章より短いけれど、静かで良かったです。最後の一行に驚きました。",
    "彼は古い地図を広げた。川の名前が一つだけ消されている。それが始まりだった。",
    "「寒いね」\n「うん」\n二人は同じ方を見ていた。",
    "父は何も言わずに傘を差し出した。雨はとっくに止んでいたのに。",
    "その家には鏡がなかった。だから誰も、自分が年を取ったことに気づかなかった。",
    "猫は三日目に見つかった。屋根裏で、五匹の子と一緒に眠っていた。",
    "今天下了一整天的雨。我们坐在窗边，没有说话。",
    "他把钥匙放在桌上，转身走了。谁也没有问他要去哪里。",
    "오늘은 아무도 오지 않았다. 나는 창문을 닫고 차를 마셨다.",
    "# The well\n\nNobody remembers who dug it. The water is cold even in August, and it tastes of iron.",
    "## 第十章\n\n彼は答えなかった。代わりに、ポケットから石を一つ取り出した。",
    "The tailor measured him in silence. When he was done he wrote down a single number, and it was the wrong one.\n- thread\n- chalk",
    "I read the scene aloud to my sister. She cried, then asked whether there was more. There isn't, not yet.",
    "Old Marek sold the horse in spring. By autumn he had walked so far behind the plough that he bought it back at twice the price.",
    "They had agreed to meet under the clock, but the station had two clocks, and each of them waited under one until dark.",
    "That was all. He put the stone back, brushed his knees and went home.",
    "He said nothing... She said nothing... The kettle said what there was to say.",
    "The first letter came in May. It had no stamp, and the paper smelled of smoke. The second came a day later; it was empty.",
    "What a strange little chapter. I kept waiting for the train, and it never came, and somehow that was fine.",
    "“Sit.” He sat. “Eat.” He ate. “Now tell me where you have been for eleven years.”",
    "The committee met on Tuesday and decided nothing. It met again on Friday, by which time there was nothing left to decide.",
    "Her hands shook. She put them under the table, where they went on shaking by themselves.",
    "The hill was steeper than he remembered, or he was older than he thought. Both, said the goat.",
    "You won't find the village on a map. Follow the river until it forks, and then ask.",
    "We left the boat where it was. In the night the tide took it, as tides do, and in the morning the argument was over.",
]
JUNK += [
    "- boots\n- rope\n- two lamps\n- bread for three days",
    "* He rowed without looking round.\n* The sea was flat and grey.\n* Gulls sat on it like stones.",
    "• The pump broke in June.\n• By July we carried water.\n• Nobody sang.",
    "1) The ferry was late.\n2) The cook blamed the captain.\n3) The rest of us ate bread.\n4) Nobody paid.",
    "(1) The clerk stamped the form.\n(2) She sighed.\n(3) She stamped it again.",
    "1. ferry\n2. captain\n3. cook\n4. bread\n5. tide",
    "1、雪は三日続いた。\n2、弟が手を振った。\n3、屋根の上は明るかった。",
    "・雪は三日続いた。\n・弟が手を振った。\n・屋根の上は明るかった。",
    "・汽車\n・鞄\n・坂\n・帽子\n・川",
    "● 網\n● 舟\n● 老人",
    "Chapter 1: The ferry ..... 3\nChapter 2: The captain ..... 19\nChapter 3: The tide ..... 40",
    "The ferry ... 3\nThe captain ... 19\nThe tide by the old pier ... 40\nThe bread ... 52",
    "第1章 汽車……3\n第2章 鞄……21\n第3章 坂の上……48",
    "第1話：汽車\n第2話：鞄\n第3話：坂の上",
    "| Scene | Page |\n|---|---|\n| ferry | 3 |\n| captain | 19 |\n| tide | 40 |",
    "| The ferry was late. | 渡し船は遅れた。 |\n| Nobody paid. | 誰も払わなかった。 |\n| The tide turned. | 潮が変わった。 |",
    "| 汽車 | train |\n| 鞄 | bag |\n| 坂 | slope |",
    "汽車｜train｜1\n鞄｜bag｜4\n坂｜slope｜9",
    "name\tcount\tshare\nferry\t12\t0.31\ntide\t8\t0.20\nbread\t5\t0.13",
    "The ferry was late.\t渡し船は遅れた。\t0.82\nNobody paid.\t誰も払わなかった。\t0.77",
    "id,name,page\n1,ferry,3\n2,captain,19\n3,tide,40",
    "0,\"The pump broke in June.\",\"ポンプが壊れた。\",0.91\n1,\"Nobody sang.\",\"誰も歌わなかった。\",0.88\n2,\"It rained.\",\"雨だった。\",0.7",
    "a;b;c\n1;2;3\n4;5;6\n7;8;9",
    "{\"scene\": \"ferry\", \"page\": 3, \"done\": true}",
    "[{\"jp\": \"雨だった。\", \"en\": \"It rained.\"}, {\"jp\": \"雪だった。\", \"en\": \"It snowed.\"}]",
    "{\n  \"model\": \"alpha\",\n  \"score\": 0.31,\n  \"notes\": [\"ferry\", \"tide\"]\n}",
    "model = alpha\ntemperature = 0.2\nretries = 3\ntimeout = 60",
    "model: beta\nscore: 0.7\nparts: 12\nseen: 4",
    "2024-01-03 10:22:01 INFO fetch part=3 ms=120\n2024-01-03 10:22:04 INFO fetch part=4 ms=98\n2024-01-03 10:22:09 WARN retry part=5",
    "10:22:01 ok\n10:22:04 ok\n10:22:09 failed\n10:22:15 ok",
    "ERROR at line 14: unexpected token '}'\nERROR at line 15: unexpected token ')'\nERROR at line 19: end of file",
    "Home\nNext\nPrevious\nLog in\nSign up\nHelp",
    "Home > Stories > The ferry > Chapter 3",
    "« Previous | Contents | Next »",
    "前へ | 目次 | 次へ | ホーム | ログイン",
    "目次\n次へ\n前へ\nログイン\nシェア",
    "Share Tweet Reply Like Share Tweet Reply Like Report",
    "ferry / 渡し船\ncaptain / 船長\ntide / 潮",
    "渡し船 = ferry\n船長 = captain\n潮 = tide\n網 = net",
    "ferry → boat\ncaptain → skipper\ntide → flood",
    "ferry, captain, cook, tide, bread, rope, lamp, boots, net, gull, pier, sail",
    "汽車、鞄、坂、帽子、川、網、舟、老人、海",
    "boots rope lamp bread tide captain cook gull net pier sail mast deck",
    "汽車 鞄 坂 帽子 川 網 舟 老人 海 雪 屋根 弟",
    "0.12 0.55 0.91\n0.33 0.20 0.04\n0.78 0.61 0.49",
    "12 55 91 33 20 4 78 61 49 12 55 91 33",
    "3.14159265358979323846264338327950288419716939937510",
    "==========================================",
    "・・・・・・・・・・・・・・・・・・・・・・・・・・",
    "hahahahahahahahahahahahahahahahahahahahahahahaha",
    "ああああああああああああああああああああああああああああああ",
    "?????????????????????????????????????????",
    "@#$%^&*()_+{}|:<>?~`-=[];',./ @#$%^&*()_+{}|:<>?",
    "x9$k #q2; }}{{ /// 0x1f &&& ~~ ::: |||",
    "Thsi eht rof nda ti saw eh nehw erofeb ton dluow taht",
    "e t h a w r i n o s d l u c m f y p g b v k x q j z e a t o i",
    "é›¨ã\x81 ã\x81£ã\x81Ÿã\x80‚é›ªã\x81 ã\x81£ã\x81Ÿã\x80‚",
    "\ufffd\ufffd\ufffdthe\ufffd\ufffd \ufffd\ufffd\ufffd ra\ufffd\ufffd \ufffd\ufffd\ufffd\ufffd",
    "た雪続三は日いた手弟振がっをた根屋明のはった上かる",
    "Marek      12   3.10% #\nBerta      88  22.80% #####\nInes      140  36.30% ########",
    "ferry    ####\ntide     ##\nbread    #########",
    "Scene 1 Scene 2 Scene 3 Scene 4 Scene 5 Scene 6",
    "https://example.org/a/1 https://example.org/a/2 https://example.org/a/3",
    "<div><a href='x'>1</a><a href='y'>2</a><a href='z'>3</a></div>",
    "<tr><td>ferry</td><td>3</td></tr><tr><td>tide</td><td>40</td></tr>",
    "def f(x):\n    return x + 1\n\nprint(f(2))",
    "for i in range(9): a[i] = b[i] * c; d += a[i]",
    "SELECT id, page FROM scenes WHERE page > 3 ORDER BY page",
    "A. ferry\nB. captain\nC. tide\nD. bread",
    "a) boots\nb) rope\nc) lamp",
    "# Scenes\n- ferry\n- captain\n- tide",
    "## Words\n\n- 汽車\n- 鞄\n- 坂",
    "Words of this chapter:\nferry 3\ncaptain 2\ntide 9\nbread 1",
    "It rained.\n| a | b | c |\n| 1 | 2 | 3 |\n| 4 | 5 | 6 |\n| 7 | 8 | 9 |\n| 1 | 2 | 3 |",
    "A list follows.\n1. boots and rope\n2. lamps and oil\n3. bread and salt\n4. nets and hooks\n5. tar",
    "[001] ferry [002] captain [003] tide [004] bread",
    "Part 1\nPart 2\nPart 3\nPart 4\nPart 5",
    "2024-01-03\n2024-01-04\n2024-01-05\n2024-01-06",
    "Tags: sea, ferry, tide\nLength: 3,120\nStatus: open\nUpdated: 2024-01-03",
    "+1 +1 +1 -1 +1 +1 -1 -1 +1 +1",
]
CHECKED = [(t, True) for t in PROSE] + [(t, False) for t in JUNK]
