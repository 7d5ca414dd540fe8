"""Terms and phrases of abusive, hateful and sexual language, without accents and in lower case.

A phrase is words in order; "~" allows up to three words between; {name} stands for any term of that list. Every word
also matches its disguised and misspelled forms (see automata). Weights: 1 or more flags by itself.
"""

#: Insulting nouns; plurals in s are added by rule.
INSULTS = """idiot moron imbecile loser scum rat parasite maggot bastard asshole arsehole dumbass clown coward trash vermin
cretin scumbag jackass retard douchebag dipshit shithead prick twat wanker bitch whore cunt slut dickhead imbecil idiota
basura mierda gilipollas cabron ordure connard salope abruti imbecile vollidiot versager dreck arschloch trottel
abschaum wichser miststuck schwein""".split()
INSULTS += """halfwit nitwit dimwit numbskull fuckwit motherfucker fucker pervert degenerate lowlife sleazebag bellend tosser
pillock buffoon dunce simpleton asshat dumbfuck shitbag fuckface cocksucker jerk filth idioten hurensohn fotze hure
spast drecksau dummkopf mistkerl blodmann encule enfoire batard pute debile bouffon salaud salauds estupido estupida
pendejo puta hijoputa subnormal payaso capullo cabrones imbeciles escoria idiotas""".split()

#: Words that sharpen an insult.
SHARPENERS = """worthless repulsive disgusting pathetic brainless spineless filthy miserable lying clueless stupid
useless ugly rotten erbarmlicher dummes dummer inutile asqueroso sale pauvre""".split()
SHARPENERS += """moronic idiotic vile revolting incompetent fucking bloody stinking dirty verdammter widerlicher blode sales stupide
pathetique estupido asquerosa inutil""".split()

#: Words that address someone.
ADDRESS = "you your yourself yours u ur ya you're youre you've you'll you'd du dir dich dein tu te toi ta ton vous eres tu ti usted".split()

#: Groups of people. A phrase here is a group only as a whole.
GROUPS = """women
immigrants
refugees
foreigners
migrants
muslims
jews
christians
gays
lesbians
blacks
disabled people
gay people
old people
black people
trans people
elderly people
people of that faith
people of other faiths
gens de cette religion
gens de leur religion
gente de otra religion
gente de otra fe
leute anderen glaubens
northerners
southerners
easterners
westerners
auslander
behinderte
fluchtlinge
frauen
juden
muslime
schwule
etrangers
immigres
refugies
femmes
handicapes
inmigrantes
mujeres
extranjeros
refugiados
discapacitados
arabs
asians
africans
mexicans
hindus
sikhs
catholics
protestants
atheists
homosexuals
transgender people
asylum seekers
pakistanis
indians
the disabled
the elderly
cripples
turken
araber
migranten
homosexuelle
alte leute
musulmans
juifs
arabes
homosexuels
migrantes
musulmanes
judios
homosexuales
ancianos""".splitlines()

#: Words of contempt for a group that are hateful by themselves.
SLURS = "nigger nigga kike spic chink gook wetback raghead towelhead paki faggot fag tranny kanake kanaken schwuchtel bougnoule youpin sudaca maricon".split()

#: Contempt or exclusion; hateful near a group.
CONTEMPT = """do not deserve to live
does not deserve to live
should not live
lock them all up
should all be locked up
should be in camps
verdienen es nicht zu leben
verdienen nicht zu leben
gehoren alle eingesperrt
alle einsperren
alle abschieben
alle rauswerfen
ne meritent pas de vivre
ne merite pas de vivre
faudrait enfermer
faudrait les enfermer
faudrait expulser
faudrait les expulser
enfermer tous
expulser tous
no merecen vivir
no merece vivir
deberian encerrar
hay que encerrar
hay que expulsar
encerrar a todos
expulsar a todos
would rather ~ than see
send ~ back
back where they came from
back to where they came from
get out of our country
out of our country
have no place
have no business
do not belong
nothing but trouble
are filth
are trash
are scum
are garbage
are rats
are dogs
are criminals
are savages
are filthy
are disgusting
are inferior
are worthless
are stupid
are lazy
cannot be trusted
can not be trusted
should not vote
should not work
should never work
should never vote
should never be allowed
should be put down
should be sterilized
should stay in the kitchen
haben hier nichts verloren
haben hier nichts zu suchen
nichts zu suchen
gehoren eingesperrt
gehoren abgeschoben
sind dreck
sind abschaum
sind ratten
sind dumm
n'ont rien a faire ici
n'ont pas leur place
dehors les
sont des rats
sont des betes
sont inferieures
sont inferieurs
son inferiores
son escoria
son ratas de
no pertenecen
que se vayan
no tienen lugar
not real humans
breed like
like vermin
are vermin
inferior
get rid of
rausgeworfen
kein mensch
dieses pack
weg mit ihnen
vermine
dehors tous
inferieures
inferieurs
son ratas
que los echen
inferiores
subhuman
should be exterminated
should be deported
do not belong here
should be banned
should be locked up
should be shot
should be killed
should be gassed
should be thrown out
should not be allowed
do not deserve
not welcome here
go back where
go back to your
send them back
send them home
send them all back
kick them out
throw them out
keep them out
lock them up
no place for
not human
less than human
lesser beings
belong in the kitchen
too stupid to
too dumb to
cannot think
are animals
are parasites
are a disease
are a plague
wipe them out
deport them
deport all
ruin everything
raus mit
gehoren nicht hierher
keine menschen
minderwertig
untermenschen
ungeziefer
abgeschoben
rentrent chez eux
rentrez chez vous
pas des humains
sont des animaux
sont des parasites
bons a rien
fuera de aqui
no son humanos
no son personas
vuelvan a su pais
son basura
son animales""".splitlines()

BODY = "neck legs face head skull teeth throat arms jaw bones nose".split()

#: Threats and insults that need no further cue.
ABUSE = {
    1.2: """kill you all
kill your family
beat the shit out of you
kick your ass
kick your teeth
put a bullet in
come to your house
coming for you
coming after you
make you pay for
make you suffer
make you regret
bury you alive
blow your head off
cut your throat
strangle you
choke on
eat shit
go fuck yourself
go screw yourself
kiss my ass
lick my
suck it
you make me sick
nobody likes you
everyone hates you
no one would miss you
nobody will miss you
world would be better without you
do the world a favor
you are nothing
you are worthless
you are pathetic
you are disgusting
you piece of
you stupid
you dumb
you fucking
you little
kill yourself
nobody would miss you
stop breathing
find out where you live
know where you live
break your jaw
break your legs
break your neck
watch your back
hope you die
hope you choke
smash your face
going to hurt you
going to kill you
go die
geh sterben
wo du wohnst
breche dir
halt ~ fresse
du versager
va crever
sale ordure
ferme ta gueule
pauvre con
espece de cretin
ou tu habites
casser la gueule
casser la figure
vais te tuer
te voy a matar
ich bringe dich um
pedazo de basura
ojala te mueras
donde vives
partir la cara
hijo de perra
hijo de puta
imbecil asqueroso
will kill you
gonna kill you
want to kill you
will hurt you
will find you and
will hunt you
beat you up
drop dead
die in a fire
rot in hell
burn in hell
hope you rot
hope you suffer
fuck you
fuck off
hang yourself
shoot yourself
end your life
you should die
you deserve to die
better off without you
waste of oxygen
waste of skin
son of a bitch
verpiss dich
fick dich
verrecke
halt ~ maul
bring dich um
schlag dich
nique ta
va te faire
fils de pute
vete a la mierda
que te jodan
muerete
te voy a romper
te voy a partir""".splitlines()
    + [f"{v} your {b}" for v in ("smash", "slit", "crack", "bash", "break") for b in BODY],
    0.7: """crawl back under
shut up
cierra la boca
ta gueule
screw you
piss off
piece of shit
piece of garbage
go to hell
halt die klappe
hau ab
casse toi
callate""".splitlines(),
}

SEXUAL = {
    1.2: """between her legs
between her thighs
between his legs
up her skirt
under her skirt
moaned with pleasure
i get hard
get me hard
makes me hard
make me so hard
makes me so wet
zwischen ihre beine
zwischen die beine
unter ihren rock
stohnte vor lust
macht mich geil
entre ses cuisses
entre ses jambes
sous sa jupe
gemit de plaisir
me fait bander
entre sus piernas
entre las piernas
bajo su falda
gemia de placer
me pone duro
want to fuck you
wanna fuck
want to lick
lick your
suck your
ride my
spread your legs
take off your clothes
take your clothes off
come to my bed
sleep with me
get you naked
make you cum
cum on
came inside
inside her
inside me
hard cock
sexy pics
hot nudes
sugar daddy
escort service
adult videos
fick mich
will dich ficken
blas mir
baise moi
suce ma
chupame
quiero follarte
blowjob
send me your nudes
nude pics
sex videos
free porn
hardcore clips
horny singles
see ~ naked
nackte frauen
fur pornos
filles nues
videos porno
chicas desnudas
porno gratis
porno gratuites
suck my
my cock
my dick
your pussy
her pussy
wet pussy
cumshot
gangbang
fuck me
fucked her
fucked him
sex with me
naked pics
naked photos
nude photos
nude pictures
naked women
naked girls
see you naked
want to see ~ naked
sex tonight
sex chat
live sex
xxx videos
undressed her
nacktbilder
sexvideos
photos nues
femmes nues
sexe gratuit
mujeres desnudas
fotos desnudas
sexo gratis""".splitlines(),
    0.6: """nudes
porno
pornos
porn
xxx
horny
orgasm
masturbate
masturbating
boobs
tits
penis
vagina
cock
pussy
erotic
nackte
titten
ficken
muschi
desnudas
follar
tetas
threesome
sexting""".splitlines(),
}

#: Reports and rules about such conduct.
REPORTING = "policy policies complaint complaints forbid forbids hotline harassment report reports describes tribunal court alleged investigation investigated training screens producers screening guidance staff".split()
#: Remarks on oneself, before an insult.
SELF = ["i was an", "i was a", "i am an", "i am a", "i feel like a", "call me an", "call me a", "myself an", "myself a"]
#: Exclamations that make the insult meant for somebody.
OPENERS = ["what a", "like you", "so ein", "you are a", "you are an", "he is a", "she is a", "he is an", "she is an", "bunch of", "espece de", "pedazo de", "this guy", "that guy"]
#: Ordinary words that look like misspelled terms: a word is no misspelling.
ORDINARY = """price prices priced pride share change changes charged lower lowers lease stock stocks write writes figures
bridge counts count while where whose those drawn wager rates rate nicht entra donne cours toward crown crowns carbon
batch slope interior closer close losses loses loss honey thorny things breath breaths patch pitch score prime
parade paradise discussing certain clowns cloud court courts water waters leave leaves whole stuck drain wrote""".split()
#: The same, by rule: words of public tokenizer vocabularies (English, German, French, Spanish) that a misspelled term could be.
ORDINARY += """abort aire allege alleges ander animal anker annot apiece arab atheist aunt backs bags baked bales banker bankers
banner bater batter bays beak beasts beide beige being belang bell belle belli bells belongs bench bene besser beter
bever bigger bikes bill billed binge birch bitten bitter blade blank bleak blend block blocked blocking blocks blonde
blood blown blue blues blush bombs bonds bone bonus books boots boring born boron bother bould bout boxes brack brain
brash brawl breaching bread breaks breast bred breeds brewed brick bricks brig bright brinc bringen brings brink
brunch buck buffer bully bunt bure busted butter canker canned cannon cant case cases cass caste caster catch cater
cause cent centre cents charg charger charges chef chick chicks chicos chiefs chin china chips choked chore chores
chose chunk chunks claps classe clever click clip clut coke collar comen complain complainant complains compliant
cones conna connot cont cooks corn coron cort could cour cout crabs cracks crank crash craw creed crew cringe crippled
cult cum cure cures curt cust cut cute cuts dance dances datas days deck decks deine depart departed depot describe
described deserved deserves dever dews dicht diese diesel diesem diesen dieser disable diseases ditch dives docking
doing dollar done draining drains dressed drinks drummer duck dude dudes dying eater eight eine elong emit enter
entire entren entry espec especie espect estre eure ever exotic exting fair fairy fait faiths faked fare father femme
fera ferm fever fiance fifth fight figur figura figured files fill fille filled filler fills filt financed finances
financi fique flags flick flips flown flying foreigner forme foto fragen freak freed freuen frick fright fringe fuer
fuerza funk gain gals gaps garage gars gas gasped gather gene genre gent gentle gill ging girl gives glowing glut
goods gotten grabs grain granny greed grote gute gutes guys habits hare haste hatch heure heures heute hews highs
hikes hill hinaus hire hires histor hitch hole homosexual hooks horn horns hospitals hours howard hue huge humane
humano hunch hunts hur hurd hurts ihren ill immigrant incompetence indian indiana inland investigate investigates
investigating investigations investigative investigator islands itch jaws jeden jelly jets jew jewe jorn jours junt
juven kanske keinen keiner kell killer kills kiln kilo kilt kisses kitchens kitten kleine klick knee koll komen kunt
lace lack lacked lacking lacks lags laser lasers latch later laying lays lesbian lessen letter leuke leve lever lick
licking ligger light likes ling lips lives locker looked looking looks lose lover lovers luck lunch lure maar males
manned mash masse masturbation mata match mater medio meine meio mente mentre metro might migrant mikes mill missed
mocked mocking moderators monde moon moons morbid mormon mothers mould muerte mute named newer news nich niche niece
night nights node nodes nooks nuda nudge nue nuke onde onder ones other ounce ounces ours ousted pace pages pakistan
palace parti partic partie partis passe passed passer past paste pater pays peace peine pens peoples perks persona
personal persones persons peuple photo photon photons piace pick picks picture pictured pieces pikes pill pissed plac
placed places plagued plane plaque plate plut polic police polity pon por pore pork port poser presses producer
produces pron puck pue pues punch punt pure pushes put puts putt rack rags rain raining ranker rans rash rata rays
reck reed refugee regard regards regenerate religions reported reserve resort resorts rever revolving reward rewards
richt rights rigt ring rocked rocking rooks rude runt rushed sabes salad salads salts salud salut sash saves says
scaff scales scam scams scares scoot scree screen screenings screws seat seating seeker seine sente setback setbacks
setting sever shades shakes shapes shards shared sharks shirt shook shoots shore shores short shouldn shout shrew
shuts sick sighs sight sill single singled sinking sitten skill skilled skirts skulls slack slash slat slic slice
slips slopes slot slots slug slum slums slur slurs smoot spat specs spice spices spicy spies spikes spins stack stares
starter stash stick sticking stiff strangers struck stuff stuk sucked sucker sucking suffers sum summer sums sunt sure
swat swatch swear sweats sweaty sweet swept swum tags tales tanker tankers taste tat teas temas tenth terme terra
texting thank thats there thick thief thigh thin thing thinks thrash threat threw thro throats throb throws tierra
tight till tink tones torn tossed tours towards track trailing train trainings trains tran traps trays trick tricks
tuck tucked turkey twit tying tyranny unch unden unique unser unt unter used vaginal verein verme very vibes video
vines vive vivid vying wages waiter wander wasted wastes watery ways weave welcomed welcomes whale wholes wicht witch
wives woman wore world worn wouldn wound woven wreck wunder zitten zones""".split()
#: Terms of four letters whose misspellings are looked for, at a lower certainty.
SHORT = "kill scum cunt slut twat porn nude jews gays fuck puta pute hure slag".split()
#: Words too common to look a phrase up by.
COMMON = """a about after again against all am an and any are as at back be because been before being between both but by can
cannot could did do does down each every few for from get go had has have he her here him his how i if in into is it its just
know like little make me more most my no nor not nothing now of off on once one only or other our out over own place said same
see she should so some such take than that the their them then there these they this those through to too under until up us
very was we were what when where which while who why will with would you your der die das und ist sind nicht ein eine einen
alle hier haben hat ich du sie wir ihr mit von zu im in auf fur den dem des es le la les un une des et est sont ne pas dans
que qui pour sur avec ce cette ces tous ici ont a el los las una y es son no en que por con su sus aqui todos de del al""".split()
