"""Given names and their short forms."""

from __future__ import annotations

# Common given names of several languages, in alphabetical order.
GIVEN = (
    "Agnes Ahmed Aisha Alan Albert Alejandro Alexander Alice Amina Andrea Andrew Angela Angelica Anna Anselm Anthony Antonio Arthur Barbara"
    " Beatrice Benjamin Bernard Boris Bridget Brigitte Carla Carlos Carmen Catherine Charles Charlotte Christina Christine Christopher Claire"
    " Clara Daniel David Deborah Diana Dieter Dmitri Dominic Donald Dorothea Dorothy Edith Edward Eleanor Elena Elizabeth Emily Emma Eric Eva"
    " Fatima Felix Fiona Florence Frances Francis Franz Frederick Gabriela Gabriele George Gerald Giovanni Gregory Hakon Hannah Hans Harold"
    " Heinrich Helen Helena Henrietta Henry Hiroshi Hugo Ibrahim Ingrid Irene Isabella Ishaan Ivan Jacqueline James Jane Javier Jean Jennifer"
    " Johannes John Jonathan Josephine Joseph Juan Judith Julia Karen Karl Katherine Kathleen Kenji Kenneth Kwame Laura Lawrence Leila Leonard"
    " Linda Louis Louise Lucas Lucy Magdalena Manuel Margaret Maria Marie Mark Martha Martin Mary Matthew Matthias Michael Michelle Mirela"
    " Mohammed Nadia Natalia Nicholas Nicole Nina Noriko Olga Oliver Olivia Oskar Ottilie Otto Patricia Patrick Paul Paula Pedro Peter Philip"
    " Pierre Priya Quentin Rachel Raymond Rebecca Richard Robert Roger Ronald Rosa Ruairi Ruth Samantha Samuel Sandra Sarah Sebastian Simon"
    " Sofia Sophie Stefan Stephen Steven Susan Susanna Theodora Theodore Theresa Thomas Timothy Tomas Umeko Ursula Veronica Victor Victoria"
    " Vincent Walter Wanjiru Werner William Wolfgang Ximena Yusuf Zofia"
).split()

# Short forms of given names (short form: full names).
SHORT = {
    "abby": "abigail", "alex": "alexander", "andy": "andrew", "angie": "angelica angela", "becky": "rebecca", "bella": "isabella", "ben": "benjamin",
    "bert": "albert", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "cathy": "catherine katherine",
    "charlie": "charles charlotte", "chris": "christopher christine christina", "dan": "daniel", "danny": "daniel", "dave": "david", "debbie": "deborah",
    "dick": "richard", "don": "donald", "dora": "theodora dorothea", "dot": "dorothea dorothy", "dottie": "dorothea dorothy", "ed": "edward", "eddie": "edward",
    "ellie": "eleanor", "fran": "frances francis", "frank": "francis", "fred": "frederick", "gabi": "gabriela gabriele", "gaby": "gabriela gabriele", "gabby": "gabriela",
    "greg": "gregory", "harry": "henry harold", "hettie": "henrietta", "etta": "henrietta", "jackie": "jacqueline", "jen": "jennifer", "jenny": "jennifer", "jim": "james",
    "jo": "josephine joseph", "joe": "joseph", "josie": "josephine", "jon": "jonathan", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kay": "katherine", "kit": "christopher",
    "larry": "lawrence", "len": "leonard", "lenny": "leonard", "leo": "leonard", "liz": "elizabeth", "lizzie": "elizabeth", "lottie": "charlotte", "maggie": "margaret",
    "matt": "matthias matthew", "meg": "margaret", "mike": "michael", "mick": "michael", "nick": "nicholas", "pat": "patricia patrick", "patty": "patricia", "peggy": "margaret",
    "pete": "peter", "phil": "philip", "ray": "raymond", "rick": "richard", "rob": "robert", "ron": "ronald", "ronnie": "veronica ronald", "sam": "samantha samuel", "sandy": "alexander sandra", "sasha": "alexander", "suzy": "susan susanna", "thea": "theodora dorothea", "xander": "alexander", "steph": "stephanie",
    "steve": "stephen steven", "sue": "susan susanna", "susie": "susan susanna", "ted": "edward theodore", "tess": "theresa", "theo": "theodore", "tim": "timothy", "tom": "thomas tomas", "tommy": "thomas",
    "tony": "anthony", "trish": "patricia", "vicky": "victoria", "vic": "victor", "vince": "vincent", "vinnie": "vincent", "wally": "walter", "will": "william",
}
