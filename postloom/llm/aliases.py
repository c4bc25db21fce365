"""Other names, abbreviations and translations of the reference entries.

Fixed values: knowledge about the trade, not learned from any table.  Each line
gives one canonical name and, after the colon, what else it is called.
"""

from __future__ import annotations

TITLES = """
Graphic Designer: Graphics Designer; Grafikdesigner; Grafikdesignerin; Graphiste; Diseñador gráfico; Diseñadora gráfica
Motion Designer: Motion Graphics Designer; Motion Graphics Artist; Motion-Designer
Video Editor: Film Editor; Video Cutter; Monteur vidéo; Monteuse vidéo; Editor de vídeo; Cutter
Illustrator: Illustration Artist; Illustratorin; Illustratrice; Illustrateur; Ilustrador; Ilustradora
Art Director: AD (Art Direction); Artdirektor; Artdirektorin; Directeur artistique; Directrice artistique; Director de arte
Creative Director: CD (Creative Direction); Kreativdirektor; Kreativdirektorin; Directeur de création; Director creativo
Copywriter: Copy Writer; Advertising Writer; Werbetexter; Werbetexterin; Concepteur-rédacteur; Redactor publicitario
UX Designer: User Experience Designer; Experience Designer (UX)
UI Designer: User Interface Designer; Interface Designer
Product Designer: Digital Product Designer
Brand Strategist: Brand Strategy Consultant; Strategist, Brand
Storyboard Artist: Storyboarder; Story Artist (Boards)
Concept Artist: Concept Illustrator; Artist, Concept
Character Animator: Character Animation Artist; Animator (Characters)
Sound Designer: Audio Designer; Sounddesigner
Colorist: Colourist; Color Grading Artist; Colour Grading Artist
Photographer: Stills Photographer; Fotograf; Fotografin; Photographe; Fotógrafo; Fotógrafa
Photo Retoucher: Image Retoucher; Retoucher (Photo)
Fashion Designer: Clothing Designer; Apparel Designer
Textile Designer: Fabric Designer
Pattern Maker: Patternmaker; Pattern Cutter
Costume Designer: Stage Costume Designer
Set Designer: Scenographer; Scenic Designer
Prop Maker: Propmaker; Props Builder
Game Designer: Gameplay Designer; Videogame Designer
Level Designer: Game Level Designer
Environment Artist: 3D Environment Artist
Texture Artist: Texturing Artist; Surfacing Artist
Rigging Artist: Character Rigger; Rigger (3D)
Visual Effects Artist: VFX Artist; FX Artist
Compositor: Digital Compositor; Compositing Artist
Music Producer: Producer (Music); Beat Producer
Composer: Music Composer; Score Composer
Podcast Producer: Podcast Maker; Producer (Podcasts)
Voice Actor: Voice Over Artist; Voice Talent
Screenwriter: Script Writer; Scenarist
Content Strategist: Content Strategy Specialist
Social Media Manager: Social Media Mgr; Social Manager; SoMe Manager
Community Manager: Community Mgr; Communities Manager
Email Designer: E-mail Designer; Designer for Email
Packaging Designer: Package Designer; Pack Designer
Type Designer: Typeface Designer; Font Designer
Book Designer: Editorial Book Designer
Web Designer: Webdesigner; Website Designer
Presentation Designer: Slide Designer; Deck Designer
Exhibition Designer: Exhibit Designer; Designer of Exhibitions
Interior Designer: Interiors Designer; Innenarchitekt; Innenarchitektin
Furniture Designer: Designer, Furniture
Jewelry Designer: Jewellery Designer
Makeup Artist: Make-up Artist; MUA (Makeup)
Wardrobe Stylist: Fashion Stylist; Stylist (Wardrobe)
Food Stylist: Culinary Stylist
Casting Director: Director of Casting
Camera Operator: Cameraman/woman; Kameramann; Kamerafrau
Lighting Technician: Light Technician; Lighting Tech
Studio Manager: Studiomanager; Manager of Studio
Design Researcher: Researcher (Design); Design Research Specialist
Creative Technologist: Creative Tech Specialist
3D Modeler: 3D Modeller; 3D Modelling Artist
Calligrapher: Calligraphy Artist; Hand Letterer
"""

SKILLS = """
Figma: Figma app; Figma (web)
Adobe Photoshop: Photoshop; Photoshop CC; Ps (Photoshop)
Adobe Illustrator: Illustrator; Illustrator CC; Ai (Adobe)
Adobe InDesign: InDesign; InDesign CC; In Design
Adobe After Effects: After Effects; AfterEffects; AE (After Effects)
Adobe Premiere Pro: Premiere Pro; Premiere; PremierePro
DaVinci Resolve: Da Vinci Resolve; Resolve
Final Cut Pro: Final Cut; FinalCut X; FCP
Blender: Blender 3D; Blender3D
Cinema 4D: Cinema4D; C4D
Autodesk Maya: Maya; Maya 3D
Houdini: Houdini FX; SideFX Houdini
ZBrush: Z-Brush; ZBrush sculpting
Unity: Unity 3D; Unity engine
Unreal Engine: Unreal; Unreal Eng.; UE5
Substance Painter: Substance 3D Painter; Substance Ptr
Webflow: Web flow; Webflow CMS
Framer: Framer sites
ProtoPie: Proto Pie
Typography: Typographic design; Typo (type setting)
Storyboarding: Storyboards; Story boards
Motion graphics: Motion gfx; Motion design; Mograph
Video editing: Editing video; Video cutting; Videoschnitt
Color grading: Colour grading; Grading (colour)
User research: UX research; Research with users
Wireframing: Wireframes; Wire framing
Prototyping: Prototypes; Rapid prototyping
Design systems: Design system work; DesignOps systems
Interaction design: Interaction dsgn; IxD
Information architecture: Info architecture; IA (information)
Brand identity: Branding; Visual identity
Copywriting: Copy writing; Writing copy; Werbetexten
Content strategy: Content strat.; Editorial strategy
Social media: Social-media; Social channels; SoMe
Search engine optimization: SEO; Search optimisation; Search engine optimisation
Email marketing: E-mail marketing; Email mktg
Art direction: Art dir.; Art directing
Sound design: Audio design; SFX design
Music production: Producing music; Musikproduktion
Fashion styling: Styling (fashion); Wardrobe styling
Pattern cutting: Pattern making; Patternmaking
Screen printing: Screenprint; Silk-screen; Siebdruck
Letterpress: Letter press
Risograph printing: Riso; Riso print
Packaging design: Packaging dsgn; Pack design
Character design: Char. design; Designing characters
Concept art: Concept artwork; Concepting (art)
Rotoscoping: Roto; Rotoscope
Green screen keying: Greenscreen; Chroma key
Photo retouching: Retouching; Retouche (photo)
Product photography: Product photos; Packshots
Drone filming: Drone footage; Aerial filming
Podcast editing: Podcast edit; Editing podcasts
Voice direction: Directing voice talent
Subtitling: Subtitles; Untertitelung
Localization: Localisation; L10n
Accessibility: A11y; Accessible design
HTML and CSS: HTML/CSS; HTML+CSS; CSS & HTML
JavaScript: Java Script; JS
Three.js: ThreeJS; Three JS
Python scripting: Python; Scripting (Python)
Canva: Canva Pro
CapCut: Cap Cut
Procreate: Pro create; Procreate (iPad)
Sketch app: SketchApp; Sketch (macOS)
Keynote: Apple Keynote
PowerPoint: Power Point; PPT
Project management: Managing projects; PM (projects); Projektleitung
Team leadership: Leading teams; Leadership (team)
Calligraphy: Kalligrafie; Hand lettering
Watercolor painting: Watercolour; Watercolour painting; Aquarelle
Paper engineering: Pop-up engineering
Bookbinding: Book binding; Buchbinden
Puppet fabrication: Puppet building; Puppet making
Stop motion: Stop-motion; Stopmotion animation
Data visualization: Data viz; Datavis; Infographics
Map design: Cartography; Kartografie
"""


def parsed(text: str) -> dict[str, list[str]]:
    """{canonical name: [other names]} of a block of lines."""
    lines = (line.split(":", 1) for line in text.strip().splitlines())
    return {name.strip(): [x.strip() for x in others.split(";") if x.strip()] for name, others in lines}


ALIASES = {"title": parsed(TITLES), "skill": parsed(SKILLS)}
